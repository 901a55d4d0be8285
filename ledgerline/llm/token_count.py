"""Greedy word-piece lengths by a linear longest-match automaton.

A text's words are runs of non-blank characters; each is matched, with one
blank in front, against the vocabulary by repeatedly taking the longest piece
that fits. The number of pieces is counted without building any: a trie of
the vocabulary has, at every node, a failure link (where matching goes on once
no longer piece fits) and the number of pieces popped on the way, so each
byte of a word is read once.

The vocabulary is a byte-level one in which every byte is a piece, so every
word can be matched. Words recur, so a worker remembers their lengths.

Defined results: null, empty and blank texts have no words and no pieces;
every row is counted, repeated rows too; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS_KEPT = 500_000  # lengths a worker remembers
_blanks = re.compile(r"[\x20\x09-\x0D]+")


def read_ranks(path: str) -> list[bytes]:
    """Pieces of a vocabulary file with a base64 piece and a rank per line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton:
    """Trie edges (node * 256 + byte -> node), failure links, popped counts."""

    def __init__(self, pieces: Iterable[bytes]):
        edges: dict[int, int] = {}
        parent, byte, piece = [0], [0], [False]
        for p in sorted(set(pieces) - {b""}):
            node = 0
            for b in p:
                key = node * 256 + b
                child = edges.get(key)
                if child is None:
                    child = edges[key] = len(parent)
                    parent.append(node)
                    byte.append(b)
                    piece.append(False)
                node = child
            piece[node] = True
        missing = [b for b in range(256) if b not in edges or not piece[edges[b]]]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        depth = [0] * len(parent)
        for v in range(1, len(parent)):  # parents come first
            depth[v] = depth[parent[v]] + 1
        fail, popped = [0] * len(parent), [0] * len(parent)
        for v in sorted(range(1, len(parent)), key=depth.__getitem__):
            if piece[v]:
                popped[v] = 1
                continue
            u = parent[v]
            z, n = fail[u], popped[u]
            while z * 256 + byte[v] not in edges:
                n += popped[z]
                z = fail[z]
            fail[v], popped[v] = edges[z * 256 + byte[v]], n
        self.edges, self.fail, self.popped = edges, fail, popped

    def length(self, word: bytes) -> int:
        edges, fail, popped = self.edges, self.fail, self.popped
        node = n = 0
        for b in word:
            child = edges.get(node * 256 + b)
            while child is None:
                n += popped[node]
                node = fail[node]
                child = edges.get(node * 256 + b)
            node = child
        while node:
            n += popped[node]
            node = fail[node]
        return n


class _Lengths(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.length(b" " + word.encode("utf-8", "surrogatepass"))
        if len(self) < WORDS_KEPT:
            self[word] = n
        return n


_lengths: dict[str, _Lengths] = {}


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row; ``path``: the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _lengths:
            _lengths[path] = _Lengths(Automaton(read_ranks(path)))
        get = _lengths[path].__getitem__
        for b in batches:
            words = [[w for w in _blanks.split(t) if w] if t else [] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array([len(w) for w in words], np.int64)),
                 pa.array(np.array([sum(map(get, w)) for w in words], np.int64))], names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_tokens bigint")
