"""Packing by concatenate and cut.

Pass 1 tokenises every text once and stores, per document, its ids and where
it starts inside its partition. The partitions' token totals are then summed
up (one row per partition), so each document knows its place in the
concatenation of all of them. Pass 2 cuts at fixed windows of ``size`` ids: a
document that crosses a window's end leaves a boundary record on each side.
Only the last sequence can be short.

Defined results: null and empty texts are the end id alone; every row is a
document of its own, repeated rows too; an empty table gives no pieces;
other columns are ignored. Special tokens' strings inside a text are read
as the tokenizer reads them by default.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import slices, stored

SIZE = 2048
END_ID = 1
CACHE = 500_000  # strings of a generation whose ids a worker remembers
STRETCH = 16 << 20  # bytes of text split at a time
TOGETHER = 200  # plain words given to the tokenizer in one text

_known: dict[str, Memory] = {}


class Memory:
    """A tokenizer and the ids of strings it has met lately.

    Two generations of at most CACHE strings: what is used moves to the young
    one; when that is full, it becomes the old one, and what was only in the
    old one is forgotten. Kept for the life of the worker."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [(t.content, t.normalized) for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.last[[k for x, k in vocabulary.items() if x.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, strings: list[str]) -> list[bytes]:
        """The ids of each of ``strings``, as 32-bit words."""
        found = list(map(self.young.get, strings))
        if None in found:
            missing = list({x: None for x, ids in zip(strings, found, strict=True) if ids is None})
            moved = {x: ids for x, ids in zip(missing, map(self.old.get, missing), strict=True) if ids is not None}
            new = [x for x in missing if x not in moved]
            for k in range(0, len(new), 20_000):
                moved.update(self.encoded(new[k:k + 20_000]))
            found = [moved[x] if ids is None else ids for x, ids in zip(strings, found, strict=True)]
            if len(self.young) + len(moved) > CACHE:
                self.old, self.young = self.young, {}
            self.young.update(islice(moved.items(), CACHE))
        return found

    def encoded(self, strings: list[str]) -> Iterator[tuple[str, bytes]]:
        """``strings`` with their ids. Plain words go to the tokenizer many
        together: each ends with a token that ends a word, and has no other."""
        plain = pc.match_substring_regex(pa.array(strings, pa.string()), PLAIN).to_pylist()
        alone = [x for x, p in zip(strings, plain, strict=True) if not p]
        words = [x for x, p in zip(strings, plain, strict=True) if p]
        groups = [words[k:k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        for some, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some) or ends[-1] != len(ids):
                alone += some
                continue
            raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            yield from zip(some, [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], strict=True)
        for x, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False), strict=True):
            yield x, np.array(e.ids, "<u4").tobytes()

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct blank-free chunks, one after another, and how
        many each has. The tokenizer lower-cases, and cuts between letters and
        marks, so a plain word and the marks on either side are looked up
        apart: far fewer different strings."""
        word, head = pc.utf8_trim(chunks, characters=MARKS), pc.utf8_rtrim(chunks, characters=MARKS)
        plain = pc.match_substring_regex(word, PLAIN)
        for token, any_case in self.special:  # such as <|endoftext|>: one piece, marks included
            plain = pc.and_not(plain, pc.match_substring(chunks, token, ignore_case=any_case))
        texts = pc.if_else(plain, pc.utf8_lower(word), chunks).dictionary_encode()
        strings = [*texts.dictionary.to_numpy(zero_copy_only=False).tolist(), ""]
        code = np.full((len(chunks), 3), len(strings) - 1)
        code[:, 1] = texts.indices.to_numpy()
        size = [pc.binary_length(x).to_numpy().astype(np.int64) for x in (word, head, chunks)]
        plain = plain.to_numpy(zero_copy_only=False)
        for side, n in ((0, size[1] - size[0]), (2, size[2] - size[1])):
            n = np.where(plain, n, 0)
            for k in np.unique(n[n > 0]).tolist():
                rows = np.flatnonzero(n == k)
                some = chunks.take(pa.array(rows))
                marks = (pc.utf8_slice_codeunits(some, -k) if side else pc.utf8_slice_codeunits(some, 0, k)).dictionary_encode()
                code[rows, side] = len(strings) + marks.indices.to_numpy()
                strings += marks.dictionary.to_pylist()
        ids, n = gathered(*joined(self.ids(strings)), code.ravel())
        return ids, n.reshape(-1, 3).sum(axis=1)


# Letters of which lower case and composed form are plain. Marks: all of ASCII but the apostrophe, which can begin a piece of its own ('s).
PLAIN = r"\A[A-Za-zÀ-ÖØ-öø-ÿ]+\z"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def gathered(ids: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of each of ``codes``, one after another, and how many each has:
    ``ids`` has those of code 0, 1, ... and ``size`` their numbers."""
    n = size[codes]
    after = np.cumsum(n)
    shift = (np.cumsum(size) - size)[codes] - after + n
    return ids[np.arange(after[-1] if len(after) else 0) + np.repeat(shift, n)], n


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, each text's with the end id behind them, and the
    n + 1 offsets of the texts.

    The tokenizer drops white space and no token spans it, so a text's ids are
    those of its chunks between blanks. Each distinct chunk is looked up once,
    and the ids of all places are gathered at once."""
    if path not in _known:
        _known[path] = Memory(path)
    lists = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
    chunks = lists.flatten().dictionary_encode()
    ids, size = _known[path].chunk_ids(chunks.dictionary)
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    codes = np.insert(chunks.indices.to_numpy().astype(np.int64), ends, len(size))
    ids, n = gathered(np.append(ids, np.uint32(END_ID)), np.append(size, 1), codes)
    after = np.cumsum(n)
    return ids, np.concatenate([[0], after[ends + np.arange(len(ends))]])


def token_bytes(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit words, with the end id."""
    ids, at = token_ids(pa.array(texts, pa.string()), path)
    return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """(part, doc_id, before, n, ids): ``before`` counts the ids of earlier
    documents of the partition; ids are packed in 16 bits where they fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for whole in batches:
            for some in slices(whole, 1, STRETCH):
                ids, at = token_ids(some.column(1), path)
                n = np.diff(at)
                cut = [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                small = [x.astype("<u2").tobytes() if x.max() < 1 << 16 else b"\0" + x.tobytes() for x in cut]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part)), some.column(0), pa.array(before + np.cumsum(n) - n), pa.array(n),
                     pa.array(small, pa.binary())], names=["part", "doc_id", "before", "n", "ids"])
                before += int(n.sum())

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "part bigint, doc_id bigint, before bigint, n bigint, ids binary")


PIECE = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
         "offset bigint, continues boolean")


def pack(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence; with ``with_ids`` also
    the piece's ids as 32-bit words."""
    tokens = stored(tokenised(docs, path), "tokens")
    # One row per partition of the first pass: small, and summed up in order.
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("at"), "n", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, at, n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wide = len(packed) != 2 * n
                ids = np.frombuffer(packed[1:], "<u4") if wide else np.frombuffer(packed, "<u2").astype("<u4")
                start = 0
                while start < n:
                    seq, off = divmod(at + start, size)
                    length = min(size - off, n - start)
                    piece = ids[start:start + length].tobytes()
                    rows.append((doc, start, length, zlib.crc32(piece), n, seq, off, start + length < n,
                                 *([piece] if with_ids else [])))
                    start += length
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "continues",
                     *(["ids"] if with_ids else [])]
            types = [pa.int64()] * 7 + [pa.bool_(), *([pa.binary()] if with_ids else [])]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return placed.mapInArrow(run, PIECE + (", ids binary" if with_ids else ""))
