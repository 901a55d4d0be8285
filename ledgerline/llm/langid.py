"""Language identification by prediction by partial matching (PPM).

Training counts byte contexts of up to three bytes for each language (a
context tree), then freezes, for every context and next byte, the exact code
length under escape method C: a byte seen after the context costs
-log2(count / (total + distinct)), an unseen one costs the escape
-log2(distinct / (total + distinct)) plus its length in the next shorter
context, down to a uniform code. Whatever the sample holds stays in the tree,
in sparse tables of the strings and contexts seen. A byte's length is rounded
to 1/1024 bits, so a text's length is an exact integer sum. The language with the shortest code
wins; ties go to the name that sorts first.

Only the classifier is fitted on a sample: stretches of ``STRETCH``
characters (shorter texts whole) drawn by a hash of doc_id and the stretch's
number, at a rate that makes a language's share about ``sample_chars``
characters however long its documents are, and at least one stretch of every
language. A stretch is learned as a text of its own. Prediction covers whole
texts of all rows. The tables hold one length for each string of the sample
and language, so with hundreds of languages ``sample_chars`` has to be lower.

Defined results: null text or text without a letter is ``und`` with score 0,
and so is every text where nothing was learned; a null doc_id is not held
out and not learned from; repeated rows are each predicted; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import slices, text_bytes

UNDETERMINED = "und"
SAMPLE_CHARS = 2_000_000  # about so many characters of each language train the model
STRETCH = 4096  # characters drawn together
UNIT = 1024  # lengths are in 1/1024 bits
DRAWS = 1_000_000_000_000  # steps of the rate of drawing
PIECE = 1 << 18  # bytes counted, or bytes times languages scored, at a time


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def gram_counts(docs: DataFrame, sample_chars: int) -> DataFrame:
    """(lang, gram, n): counts of four-byte strings (as integers; three zero
    bytes stand before each text) in the training sample."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                         & ~held_out())
    usable = usable.select(F.col("doc_id").cast("string").alias("id"), F.col("lang").cast("string").alias("lang"),
                           F.col("text").cast("string").alias("text"))
    usable = usable.withColumn("chars", F.char_length("text")).filter(F.col("chars") > 0)

    def draw(stretch: Column) -> Column:
        return F.pmod(F.xxhash64("id", stretch), F.lit(DRAWS))

    sizes = usable.groupBy("lang").agg(F.sum("chars").alias("all"), F.min(draw(F.lit(0))).alias("least"))  # one row a language
    rate = F.least(F.lit(1.0), F.lit(float(sample_chars)) / F.col("all"))
    drawn = usable.join(F.broadcast(sizes.select(F.col("lang").alias("of"), rate.alias("rate"), "least")), F.col("lang") == F.col("of"))
    numbers = F.sequence(F.lit(0), F.floor((F.col("chars") - 1) / STRETCH).cast("int"))
    numbers = F.filter(numbers, lambda k: (draw(k) < F.col("rate") * DRAWS) | ((k == 0) & (draw(k) == F.col("least"))))
    parts = F.transform(numbers, lambda k: F.substring(F.col("text"), k * STRETCH + 1, F.lit(STRETCH)))
    # The outer form: the plain one adds a filter that draws once more.
    drawn = drawn.select("lang", F.explode_outer(parts).alias("text")).filter(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 1, PIECE)):
            langs = np.array(b.column(0).to_pylist(), object)
            raw, off = text_bytes(b.column(1))
            gram = grams(raw, off)
            doc = np.repeat(np.arange(len(langs)), np.diff(off))
            for lang in sorted(set(langs)):
                g, n = np.unique(gram[(langs == lang)[doc]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)],
                                                 names=["lang", "gram", "n"])

    counts = drawn.select("lang", "text").mapInArrow(run, "lang string, gram bigint, n bigint")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def grams(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The three bytes before each byte and the byte, as one integer."""
    b = raw.astype(np.int64)
    place = np.arange(len(b)) - np.repeat(off[:-1], np.diff(off))
    out = b.copy()
    for k in (1, 2, 3):
        back = np.zeros_like(b)
        back[k:] = b[:-k] if k <= len(b) else 0
        out += np.where(place >= k, back, 0) << (8 * k)
    return out


class Level(NamedTuple):
    """Contexts of one length: sorted strings (context and next byte) with
    their code lengths, sorted contexts with their escapes, by language."""

    strings: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys``, and which of them are there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Model:
    """Frozen code lengths in bits: of each byte without context, and of each
    context length the strings and contexts of the sample."""

    def __init__(self, langs: list[str], single: np.ndarray, levels: list[Level]):
        self.langs, self.single, self.levels = langs, single, levels

    def bits(self, gram: np.ndarray, depth: int) -> np.ndarray:
        """(grams, languages) code lengths of the last byte of each gram after
        the ``depth`` bytes before it."""
        if depth == 0:
            return self.single[gram & 255]
        level = self.levels[depth - 1]
        gram = gram & ((1 << 8 * (depth + 1)) - 1)
        at, seen = find(level.strings, gram)
        out = level.bits[at]
        if not seen.all():
            rest = gram[~seen]
            at, known = find(level.contexts, rest >> 8)
            out[~seen] = self.bits(rest, depth - 1) + np.where(known[:, None], level.escapes[at], 0.0)
        return out

    def lengths(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(texts, languages) code lengths in 1/UNIT bits."""
        out = np.zeros((len(off) - 1, len(self.langs)), np.int64)
        step = max(1, PIECE // len(self.langs))
        for at in range(0, len(raw), step):
            end = min(at + step, len(raw))
            lo = max(0, at - 3)
            gram = grams(raw[lo:end], np.clip(off, lo, end) - lo)[at - lo:]
            units = np.rint(self.bits(gram, len(self.levels)) * UNIT).astype(np.int64)
            doc = np.repeat(np.arange(len(out)), np.diff(np.clip(off, at, end)))
            first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            out[doc[first]] += np.add.reduceat(units, first, axis=0)
        return out


def freeze(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """Context trees of all languages (``lang`` has places in ``langs``) from
    the summed counts, from the shortest contexts to the longest."""

    def by_language(keys: np.ndarray, size: int, weights: np.ndarray, lang: np.ndarray) -> np.ndarray:
        return np.bincount(keys * len(langs) + lang, weights=weights, minlength=size * len(langs)).reshape(size, len(langs))

    def level(depth: int, shorter: Model | None) -> Level:
        strings, place = np.unique(gram & ((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        counts = by_language(place, len(strings), n, lang)
        contexts, row = np.unique(strings >> 8, return_inverse=True)
        text, own = np.nonzero(counts)
        total = by_language(row[text], len(contexts), counts[text, own], own)
        kinds = by_language(row[text], len(contexts), np.ones(len(text)), own)
        # Method C; a language that never saw the context goes on without an escape.
        escapes = np.log2(np.where(kinds > 0, (total + kinds) / np.maximum(kinds, 1), 1))
        lower = shorter.bits(strings, depth - 1) if depth else np.full((len(strings), len(langs)), 8.0)
        bits = np.where(counts > 0, np.log2(np.maximum(total + kinds, 1)[row] / np.maximum(counts, 1)), lower + escapes[row])
        return Level(strings, bits, contexts, escapes)

    bottom = level(0, None)
    single = 8.0 + np.repeat(bottom.escapes, 256, axis=0)
    single[bottom.strings] = bottom.bits
    model = Model(langs, single, [])
    for depth in (1, 2, 3):
        model.levels.append(level(depth, model))
    return model


def train(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """The model of ``docs`` (doc_id, text, lang), None if nothing can be
    learned. The counts that reach the driver are bounded by the sample."""
    rows = gram_counts(docs, sample_chars).toArrow()
    if not rows.num_rows:
        return None
    names = rows.column("lang").combine_chunks().dictionary_encode()
    langs = names.dictionary.to_pylist()
    rank = np.argsort(np.argsort(np.array(langs, object), kind="stable"), kind="stable")
    return freeze(sorted(langs), rank[names.indices.to_numpy()], rows.column("gram").to_numpy(),
                  rows.column("n").to_numpy().astype(np.float64))


PREDICTION = "doc_id bigint, held_out boolean, lang_pred string, score double, bits_per_byte double"


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """A prediction for every row of ``docs`` (doc_id, text)."""
    text = F.col("text").cast("string")
    spoken = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"),
                       F.when(spoken, text).alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("bits_per_byte"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *label(shared.value, b.column(2))],
                                             names=["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    return rows.mapInArrow(run, PREDICTION)


def label(model: Model, texts: pa.Array) -> list[pa.Array]:
    """Language, its share of the probability, and bits a byte of each text."""
    raw, off = text_bytes(texts)
    size = np.diff(off)
    bits = model.lengths(raw, off) / UNIT
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(best)), best]
    share = 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1)
    names = np.array([*model.langs, UNDETERMINED], object)[np.where(size > 0, best, len(model.langs))]
    return [pa.array(names.tolist(), pa.string()), pa.array(np.where(size > 0, share, 0.0)),
            pa.array(np.divide(least, size, out=np.zeros(len(size)), where=size > 0), mask=size == 0)]


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """Struct (lang, score) of a text column, for stages that keep their other columns."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def name(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(label(shared.value, texts)[:2], names=["lang", "score"])

    # So marked, a filter on the result is not merged with it: texts go to Python once.
    return name.asNondeterministic()(F.when(text.rlike(r"\p{L}"), text))


def identify(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """Train on the rows that are not held out, predict all."""
    return predict(docs, train(docs, sample_chars))
