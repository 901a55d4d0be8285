"""Spelling variants of frequent words, by asymmetric q-chunks.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. Such an edit falls into one piece of the shorter word (or of
either, where they are equally long) and leaves two disjoint chunks of it
whole: what stands before the piece and what stands after it.

1. One word contributes, for each of its pieces, the two chunks around it.
   The other contributes its positional grams of the same lengths: at its
   start, and ending at its end, which is where the chunks must lie after an
   edit within the piece (a shift of one at most). Grams that no chunk could
   meet are not made.
2. Both are joined on the chunks' hash, length and place. Pieces have two code
   points (longer only in words of over 64), so the words that share both
   chunks are bounded by the alphabet, not by the number of words.
3. Every pair is verified by its edit distance.

Each word's form is its most frequent near word, if that is frequent enough;
roots follow the forms by pointer jumping. A form is at least ``RATIO`` times
as frequent as its word, so chains are short and have no cycle.

Defined results: null, empty and letterless texts have no words; repeated rows
count each time; a row without a doc_id keeps its runs as they are; other
columns are ignored; an empty table has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, stored, text_bytes
from ledgerline.llm.shingles import BASE, mix

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7  # code points of a word
LEAST_COUNT = 2
RATIO = 10  # a form is so many times as frequent as its word
EDITED = 31  # one run in so many is edited
PIECE = 2  # code points
MOST_PIECES = 32
BATCH = 1 << 21  # keys made at a time


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the distinct words of all whole texts and how often they occur."""
    text = F.col("text").cast("string")
    runs = docs.select(F.col("doc_id").cast("string").alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    plain = F.octet_length("run") == F.char_length("run")
    runs = runs.select("id", F.when(plain, F.lower("run")).otherwise(ascii_lower(F.col("run"))).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"),
                       F.char_length("run").alias("size"))
    cut = (F.col("h") % F.col("size")).cast("int")
    edited = F.concat(F.substring(F.col("run"), F.lit(1), cut), F.substring(F.col("run"), cut + 2, F.col("size")))
    word = F.when(F.col("h") % EDITED == 0, edited).otherwise(F.col("run"))
    found = runs.select(word.alias("word")).filter(F.char_length("word") >= LEAST_LENGTH)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def cuts(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of a word of ``size`` code points."""
    n = max(1, min(MOST_PIECES, -(-size // PIECE)))
    at = np.arange(n + 1) * size // n
    return at[:-1], at[1:]


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the power of 0 to ``n``, modulo 2^64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def keys(points: np.ndarray, size: int) -> np.ndarray:
    """(words, pieces) hashes of the chunks around each piece of a word of
    ``size`` code points, found in ``points``, equally long words or words
    longer by one. There the piece is longer by one, too."""
    extra = points.shape[1] - size
    n = points.shape[1]
    up, down = powers(int(BASE), n), powers(pow(int(BASE), -1, 2**64), n)
    total = np.zeros((len(points), n + 1), np.uint64)
    np.cumsum(mix(points.astype(np.uint64) + BASE) * up[:n], axis=1, out=total[:, 1:])
    start, end = cuts(size)
    after = (total[:, -1:] - total[:, end + extra]) * down[end + extra]
    place = mix((np.uint64(size) << np.uint64(8)) + np.arange(len(start), dtype=np.uint64))
    return mix(total[:, start] ^ mix(after + place))


def chunk_rows(found: DataFrame, short: bool) -> DataFrame:
    """(key, word, n): a row for each piece of each word, as the shorter word
    of a pair (``short``: its chunks) or as the longer one (its grams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            raw, off = text_bytes(texts)
            points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")
            # Bytes that start a code point, so byte offsets become code point offsets.
            at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]
            sizes = np.diff(at)
            for size in np.unique(sizes).tolist():
                whole = size if short else size - 1
                pieces = len(cuts(whole)[0])
                rows = np.flatnonzero(sizes == size)
                step = max(1, BATCH // max(size, 1))
                for some in (rows[k:k + step] for k in range(0, len(rows), step)):
                    matrix = points[at[some][:, None] + np.arange(size)]
                    key = keys(matrix, whole).view(np.int64).ravel()
                    part = batch.take(pa.array(np.repeat(some, pieces)))
                    yield pa.RecordBatch.from_arrays([pa.array(key), part.column(0), part.column(1)], names=["key", "word", "n"])

    return found.select("word", "n").mapInArrow(run, "key bigint, word string, n bigint")


def near_pairs(found: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every unordered pair of near words once."""
    chunks, grams = stored(chunk_rows(found, True), "chunks"), chunk_rows(found, False)
    first = chunks.toDF("key", "a", "a_n")

    def verified(other: DataFrame, once: Column) -> DataFrame:
        pairs = first.join(other.toDF("key", "b", "b_n"), "key").filter(once & (F.levenshtein("a", "b", 1) == 1))
        return pairs.select("a", "a_n", "b", "b_n")

    return verified(chunks, F.col("a") < F.col("b")).union(verified(grams, F.lit(True))).dropDuplicates(["a", "b"])


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row a word."""
    found = stored(words(docs), "words")
    pairs = near_pairs(found)
    both = pairs.select(F.inline(F.array(*[F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n"))
                                           for x, y in ("ab", "ba")])))
    # The most frequent near word; of equally frequent ones the smallest.
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n"))
    out = found.join(best, "word", "left")
    enough = F.col("near_n") >= RATIO * F.col("n")
    out = stored(out.select("word", F.when(enough, F.col("near")).alias("form"), "n",
                            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                            F.when(enough, F.col("near_n")).alias("form_n")), "forms")
    return out.join(roots(out), "word", "left").select(
        "word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, last): where the forms of each word with a form lead. Each round
    doubles the steps taken; a word occurs RATIO times less than its form, so
    a count of n ends within log2(log10(n)) + 2 rounds."""
    now = forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("last"))
    while True:
        ahead = now.select(F.col("word").alias("last"), F.col("last").alias("far"))
        step = stored(now.join(ahead, "last", "left").select("word", F.coalesce("far", "last").alias("last"),
                                                             F.col("far").isNotNull().alias("moved")), "roots")
        now = step.select("word", "last")
        if not step.filter("moved").limit(1).count():
            return now
