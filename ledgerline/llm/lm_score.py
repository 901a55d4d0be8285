"""Language-model scores from a log-frequency Bloom filter.

1. Every text is tokenised once, in slices of about ``SLICE`` bytes; a slice's
   distinct words and its tokens' places among them are stored.
2. Word counts of the training texts are exact: each slice sends its distinct
   words, with how often it has them, to hash ranges of words; these sum up
   and send the totals back. They give the base score.
3. The training n-grams of each slice are counted, then summed up by
   segments, hash ranges of about ``SEGMENT`` n-grams. A segment becomes a
   Bloom filter that holds, for an n-gram of count c, one entry for each level
   up to that of c, on a logarithmic scale. A count is read back by probing
   level after level until one is missing, so it is never too low, and too
   high by k levels with a chance that falls as the k-th power.
4. A token's probability is its count after the words before it, mixed with
   the probability from one word less (Dirichlet smoothing). An n-gram is held
   to be at most as frequent as its parts, which undoes most false entries.

The filter grows with the corpus. While it has at most ``FILTER_BYTES`` it is
broadcast to the workers; a larger one is never gathered: each slice sends its
distinct n-grams to the segments and gets their levels back, at a cost in
proportion to the input. Both ways probe the same filter and agree exactly.

Defined results: null, empty and blank texts are the end token alone; a row
without a doc_id is neither held out nor learned from; repeated rows are each
scored, and learned from; with no training text every token has probability
one in both scores; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import slices, stored
from ledgerline.llm.shingles import mix, word_hashes

ORDER = 2  # words of the longest n-gram
STEP = 2.0  # ratio of neighbouring levels' counts
PROBES, BITS = 4, 7  # places of an entry, bits for each entry: a false entry has a chance of 3.6 %
PRIOR = 4.0  # weight of the shorter context, in occurrences
ADD = 0.1  # added to each word's count
SLICE = 2 << 20  # bytes of text tokenised together
SEGMENT = 1 << 19  # words or n-grams of a hash range, each counted once a slice
MERGED = 1 << 20  # n-grams that a task sums up before it sends them
FILTER_BYTES = 96 << 20  # largest filter that is broadcast
END = 0x656E64  # hash of the end token

# The smallest count of each level; a level stands for the middle of its counts.
LEAST = np.unique(np.ceil(STEP ** np.arange(62)).astype(np.int64))
VALUE = np.concatenate([[0.0], (LEAST[:-1] + LEAST[1:] - 1) / 2, LEAST[-1:]])
_U = np.uint64


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


# --- tokens -----------------------------------------------------------------------

SLICES = ("slice bigint, doc_ids array<bigint>, held array<boolean>, learn array<boolean>, sizes array<int>, "
          "codes binary, words string, seen binary, n_words bigint, n_seen bigint")


def tokenised(docs: DataFrame) -> DataFrame:
    """One row a slice: its documents, their numbers of words, all words as
    places among the slice's distinct ``words`` (16 bits if that will do, else
    32), these joined by blanks, and how often the training documents have each
    (``seen``); how many distinct words there are, and tokens of training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for part in (p for whole in batches for p in slices(whole, 3, SLICE)):
            # Not cast to large strings first: ascii_lower misreads a slice that was.
            lists = pc.ascii_split_whitespace(pc.ascii_lower(part.column(3).fill_null("")))
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            words, owner = lists.flatten(), np.repeat(np.arange(len(sizes)), sizes)
            filled = pc.not_equal(pc.binary_length(words), 0)  # splitting leaves "" at a text's blank ends
            words, owner = words.filter(filled).dictionary_encode(), owner[filled.to_numpy(zero_copy_only=False)]
            codes = words.indices.to_numpy().astype("<u4")
            learn = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            seen = np.bincount(codes[learn[owner]], minlength=len(words.dictionary))
            small = "<u2" if len(words.dictionary) <= 1 << 16 else "<u4"
            row = [at, part.column(0).to_pylist(), part.column(1).to_pylist(), learn.tolist(),
                   np.bincount(owner, minlength=len(sizes)).tolist(), codes.astype(small).tobytes()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.bool_()),
                                                       pa.list_(pa.int32()), pa.binary()], strict=True)]
                + [pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(seen)], pa.int32()), words.dictionary), " ").cast(pa.string()),
                   pa.array([seen.astype("<u4").tobytes()]), pa.array([len(seen)], pa.int64()),
                   pa.array([int(seen.sum() + learn.sum())], pa.int64())],
                names=["slice", "doc_ids", "held", "learn", "sizes", "codes", "words", "seen", "n_words", "n_seen"])
            at += 1

    learn = ~held_out() & F.col("doc_id").isNotNull()
    return docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held"), learn.alias("learn"),
                       F.col("text").cast("string")).mapInArrow(run, SLICES)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of ``batches``, one at a time, lists as Arrow arrays."""
    pa.default_memory_pool().release_unused()  # what earlier tasks of this worker left
    for batch in batches:
        for k in range(batch.num_rows):
            cells = {name: batch.column(name)[k] for name in batch.schema.names}
            yield {name: c.values if isinstance(c, pa.ListScalar) else c.as_py() for name, c in cells.items()}


def windows(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a slice with an end after each document, as places among
    its words (the end comes last, as ``-1``); and how many tokens of the same
    document stand before each."""
    ends = np.cumsum(sizes)
    tokens = np.insert(codes.astype(np.int64), ends, -1)
    first = np.concatenate([[0], (ends + np.arange(1, len(sizes) + 1))[:-1]])
    return tokens, np.arange(len(tokens)) - np.repeat(first, sizes + 1)


def gram_keys(tokens: np.ndarray, before: np.ndarray, hashes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order`` the hash of the n-gram that ends at each token
    (of no meaning where fewer than n - 1 tokens stand before it)."""
    h = hashes[tokens]
    out = [mix(h + _U(1))]
    for n in range(2, order + 1):
        # One n-gram's hash is that of the n-gram before it, less its first word, with one more word.
        longer = np.zeros_like(h)
        longer[1:] = mix(out[-1][:-1] * _U(0x9E3779B97F4A7C15) + h[1:] + _U(n))
        out.append(longer)
    return out


def hashes_of(words: str) -> np.ndarray:
    raw = np.frombuffer(words.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]))[0]


def slice_keys(row: dict, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    sizes = row["sizes"].to_numpy().astype(np.int64)
    hashes = np.append(hashes_of(row["words"]), _U(END))
    codes = np.frombuffer(row["codes"], "<u2" if len(hashes) <= (1 << 16) + 1 else "<u4")
    tokens, before = windows(codes, sizes)
    return tokens, before, sizes, hashes, gram_keys(tokens, before, hashes, order)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """Segment of each key, ascending as keys do."""
    return ((keys >> _U(32)) * _U(segments) >> _U(32)).astype(np.int64)


# --- filter -----------------------------------------------------------------------

def places(rest: np.ndarray, level: int, bits: np.ndarray | np.uint64) -> list[np.ndarray]:
    """The bits of an entry in its segment of ``bits``; ``rest`` is what of the
    key the segment does not tell."""
    with np.errstate(over="ignore"):
        h = mix(rest.astype(np.uint64) + _U(level * 0xD1B54A32D192ED03 % 2**64))
        a, b = h & _U(0xFFFFFFFF), (h >> _U(32)) | _U(1)
        return [((a + _U(k) * b) & _U(0xFFFFFFFF)) * bits >> _U(32) for k in range(PROBES)]


def fill(rest: np.ndarray, n: np.ndarray) -> bytes:
    """The filter of a segment's n-grams and their counts."""
    levels = np.searchsorted(LEAST, n, "right")
    bits = max(64, -(-int(levels.sum()) * BITS // 64) * 64)
    hit = np.zeros(bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for p in places(rest[levels >= level], level, _U(bits)):
            hit[p] = True
    return np.packbits(hit, bitorder="little").tobytes()


@dataclass(frozen=True)
class Filter:
    """Segments' filters one after the other."""

    data: np.ndarray  # bytes
    start: np.ndarray  # by segment: the first bit
    bits: np.ndarray  # by segment: how many (0: nothing was learned there)

    @classmethod
    def of(cls, found: dict[int, bytes], segments: int) -> Filter:
        sizes = np.array([len(found.get(k, b"")) for k in range(segments)], np.uint64)
        data = b"".join(found[k] for k in sorted(found))
        return cls(np.frombuffer(data, np.uint8), (np.cumsum(sizes) - sizes) * _U(8), sizes * _U(8))

    def levels(self, rest: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The level of each n-gram, by probes until one fails."""
        out, level = np.zeros(len(rest), np.int64), 1
        left = np.flatnonzero(self.bits[segment])
        rest, start, bits = rest[left], self.start[segment[left]], self.bits[segment[left]]
        while len(left) and level < len(LEAST):
            held = np.ones(len(left), bool)
            for p in places(rest, level, bits):
                p += start
                held &= (self.data[p >> _U(3)] >> (p & _U(7)).astype(np.uint8) & 1).astype(bool)
            left, rest, start, bits = left[held], rest[held], start[held], bits[held]
            out[left] = level
            level += 1
        return out


def blocks(keys: np.ndarray, segments: int, *columns: np.ndarray) -> tuple[pa.Array, list[pa.Array]]:
    """The segments of ascending ``keys``, and each column's bytes by segment."""
    segment = segment_of(keys, segments)
    cut = np.flatnonzero(np.diff(segment, prepend=-1))
    return pa.array(segment[cut]), [pa.array([x.tobytes() for x in np.split(c, cut[1:])][:len(cut)], pa.binary()) for c in columns]


@dataclass
class Model:
    """What was learned: scalars, the words' counts and the filter's segments, as stored tables."""

    order: int
    tokens: int  # N: training tokens, ends included
    distinct: int  # V: distinct ones, the end included
    ends: int  # training texts
    mass: float  # sum of the distinct tokens' counts as the filter gives them
    word_segments: int
    words: DataFrame  # segment, slice, counts: of the slice's words in this segment, in the order of their hashes
    segments: int
    filter: DataFrame  # segment, bits
    filter_bytes: int


def in_order(hashes: np.ndarray) -> np.ndarray:
    """The order in which a slice's words are sent."""
    return np.argsort(hashes, kind="stable")


def count_words(texts: DataFrame, segments: int) -> DataFrame:
    """(segment, slice, counts, distinct, mass): for each slice the training
    counts of its words; in a row without a slice, the segment's totals."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):
            hashes = hashes_of(row["words"])
            order = in_order(hashes)
            words = pa.array(row["words"].split(" ") if row["words"] else [], pa.string()).take(pa.array(order))
            seen = np.frombuffer(row["seen"], "<u4")[order]
            segment = segment_of(hashes[order], segments)
            cut = [*np.flatnonzero(np.diff(segment, prepend=-1)), len(order)]
            offsets = pa.array(cut, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(segment[cut[:-1]]), pa.array([row["slice"]] * (len(cut) - 1), pa.int64()),
                 pc.binary_join(pa.ListArray.from_arrays(offsets, words), " "),  # no word has a blank
                 pa.array([x.tobytes() for x in np.split(seen, cut[1:-1])][:len(cut) - 1],
                          pa.binary())], names=["segment", "slice", "words", "seen"])

    def add_up(rows: pa.Table) -> pa.Table:
        lists = pc.split_pattern(rows["words"], " ").combine_chunks()
        words = lists.flatten().dictionary_encode()
        codes = words.indices.to_numpy()
        seen = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in rows["seen"]])
        total = np.bincount(codes, weights=seen, minlength=len(words.dictionary)).astype("<i8")
        cut = np.cumsum(lists.value_lengths().to_numpy())[:-1]
        counts = [x.tobytes() for x in np.split(total[codes], cut)]
        segment = rows["segment"][0].as_py()
        total = total[total > 0]
        return pa.table({"segment": pa.array([segment] * (len(counts) + 1), pa.int64()),
                         "slice": pa.array([*rows["slice"].to_pylist(), None], pa.int64()),
                         "counts": pa.array([*counts, None], pa.binary()),
                         "distinct": pa.array([None] * len(counts) + [len(total)], pa.int64()),
                         "mass": pa.array([None] * len(counts) + [VALUE[np.searchsorted(LEAST, total, "right")].sum()], pa.float64())})

    asked = texts.select("slice", "words", "seen").mapInArrow(ask, "segment bigint, slice bigint, words string, seen binary")
    return stored(asked.groupBy("segment").applyInArrow(add_up, "segment bigint, slice bigint, counts binary, distinct bigint, mass double"),
                  "words")


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """A model of the stored slices' training documents."""
    asked, n, ends = texts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (
        "n_words", "n_seen", F.size(F.filter("learn", lambda x: x)))]).first()
    word_segments, segments = max(1, math.ceil(asked / SEGMENT)), max(1, math.ceil(n * order / SEGMENT))
    words = count_words(texts, word_segments)
    v, mass = words.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("mass"), F.lit(0.0))).first()
    if ends:
        v, mass = v + 1, mass + float(VALUE[np.searchsorted(LEAST, ends, "right")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def send() -> pa.RecordBatch:
            keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([n for _, n in held]))
            held.clear()
            segment, columns = blocks(keys, segments, (keys & _U(0xFFFFFFFF)).astype("<u4"), counts.astype("<u4"))
            return pa.RecordBatch.from_arrays([segment, *columns], names=["segment", "rest", "n"])

        for row in each(batches):
            _, before, sizes, _, keys = slice_keys(row, order)
            learn = np.repeat(row["learn"].to_numpy(zero_copy_only=False).astype(bool), sizes + 1)
            for n, k in enumerate(keys):
                held.append(np.unique(k[learn & (before >= n)], return_counts=True))
            if sum(len(k) for k, _ in held) >= MERGED:
                yield send()
        if held:
            yield send()

    def build(rows: pa.Table) -> pa.Table:
        rest = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in rows.column("rest")])
        n = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in rows.column("n")])
        rest, place = np.unique(rest, return_inverse=True)
        bits = fill(rest, np.bincount(place, weights=n).astype(np.int64))
        return pa.table({"segment": rows.column("segment")[:1], "bits": pa.array([bits], pa.binary())})

    grams = texts.select("learn", "sizes", "codes", "words").mapInArrow(count, "segment bigint, rest binary, n binary")
    table = stored(grams.groupBy("segment").applyInArrow(build, "segment bigint, bits binary"), "filter")
    size = table.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
    return Model(order, n, v, ends, mass, word_segments, words, segments, table, size)


# --- scores -----------------------------------------------------------------------

def levels_of(keys: np.ndarray, bits: Filter) -> np.ndarray:
    return bits.levels(keys & _U(0xFFFFFFFF), segment_of(keys, len(bits.bits)))


@dataclass(frozen=True)
class Scalars:
    order: int
    tokens: int
    distinct: int
    ends: int
    mass: float
    segments: int


def log_probabilities(before: np.ndarray, counts: list[np.ndarray], model: Scalars) -> np.ndarray:
    """log10 probability of each token from the counts of the n-grams that end at it."""
    p = (counts[0] + ADD) / (model.mass + ADD * (model.distinct + 1))
    context, gram = counts[0], counts[0]
    for n in range(1, model.order):
        # The context is the n-gram that ends at the token before; no gram is more frequent than its parts.
        past = np.concatenate([[0.0], context[:-1]])
        gram = np.where(before >= n, np.minimum(np.minimum(counts[n], past), gram), 0.0)
        past = np.where(before >= n, past, 0.0)
        p = (gram + PRIOR * p) / (past + PRIOR)
        context = gram
    return np.log10(p)


def joined(blocks: pa.Array, column: str, kind: str | type) -> list[np.ndarray]:
    """The segments' numbers, in the order of segments."""
    return [np.frombuffer(b[column], kind) for b in sorted(blocks.to_pylist(), key=lambda b: b["segment"])]


def score(docs: DataFrame, order: int = ORDER, filter_bytes: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every row, learned from the rows that are not held out."""
    texts = stored(tokenised(docs), "tokens")
    model = train(texts, order)
    limit = FILTER_BYTES if filter_bytes is None else filter_bytes
    scalars = Scalars(order, model.tokens, model.distinct, model.ends, model.mass, model.segments)

    # One number for each distinct word of a slice, which has SLICE bytes of text.
    known = model.words.filter(F.col("slice").isNotNull()).groupBy("slice").agg(F.collect_list(F.struct("segment", "counts")).alias("known"))
    rows = texts.select("slice", "doc_ids", "held", "sizes", "codes", "words").join(known, "slice", "left")
    if model.filter_bytes <= limit:
        table = model.filter.select("segment", "bits").toArrow()
        sent = docs.sparkSession.sparkContext.broadcast(
            Filter.of(dict(zip(table["segment"].to_pylist(), table["bits"].to_pylist(), strict=True)), model.segments))
    else:
        sent = None
        rows = rows.join(answers(texts, model), "slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):
            tokens, before, sizes, hashes, keys = slice_keys(row, scalars.order)
            if sent is not None:
                counts = []
                for k in keys:
                    distinct, place = np.unique(k, return_inverse=True)
                    counts.append(VALUE[levels_of(distinct, sent.value)][place])
            else:
                distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
                counts = list(VALUE[np.concatenate(joined(row["answers"], "levels", np.uint8))][place].reshape(len(keys), -1))
            c = np.full(len(hashes), scalars.ends)
            if row["known"] is not None:
                c[in_order(hashes[:-1])] = np.concatenate(joined(row["known"], "counts", "<i8"))
            base = np.log10((c + ADD) / (scalars.tokens + ADD * (scalars.distinct + 1)))
            first = np.cumsum(sizes + 1) - sizes - 1
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"], row["held"], pa.array(sizes + 1),
                 pa.array(np.add.reduceat((c > 0)[tokens].astype(np.int64), first)), pa.array(np.full(n, scalars.tokens, np.int64)),
                 pa.array(np.add.reduceat(base[tokens], first)),
                 pa.array(np.add.reduceat(log_probabilities(before, counts, scalars), first))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                "base_score double, score double")


def answers(texts: DataFrame, model: Model) -> DataFrame:
    """(slice, answers): the levels of each slice's distinct n-grams, from a
    filter too large to be broadcast. Filters and questions are dealt by
    segment and sorted, a filter before its questions, and read as a stream."""
    order, segments = model.order, model.segments

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):
            keys = np.unique(np.concatenate(slice_keys(row, order)[-1]))
            segment, (rest,) = blocks(keys, segments, (keys & _U(0xFFFFFFFF)).astype("<u4"))
            yield pa.RecordBatch.from_arrays([segment, pa.array([row["slice"]] * len(segment), pa.int64()), rest],
                                             names=["segment", "slice", "data"])

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = None, None
        for batch in batches:
            segment = batch.column(0).to_numpy()
            cut = [*np.flatnonzero(np.diff(segment, prepend=-1)), len(segment)]
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                if part.column(1)[0].as_py() is None:
                    now, bits = segment[lo], Filter.of({0: part.column(2)[0].as_py()}, 1)
                    part = part.slice(1)
                rest = [np.frombuffer(x.as_py(), "<u4") for x in part.column(2)]
                if not rest:
                    continue
                every = np.concatenate(rest)
                levels = bits.levels(every, np.zeros(len(every), np.int64)) if now == segment[lo] else np.zeros(len(every), np.int64)
                told = np.split(levels.astype(np.uint8), np.cumsum([len(x) for x in rest])[:-1])
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(0), pa.array([x.tobytes() for x in told], pa.binary())],
                                                 names=["slice", "segment", "levels"])

    asked = texts.select("slice", "sizes", "codes", "words").mapInArrow(ask, "segment bigint, slice bigint, data binary")
    filters = model.filter.select("segment", F.lit(None).cast("bigint").alias("slice"), F.col("bits").alias("data"))
    dealt = filters.union(asked).repartition("segment").sortWithinPartitions("segment", F.col("slice").asc_nulls_first())
    told = dealt.mapInArrow(reply, "slice bigint, segment bigint, levels binary")
    # One level for each distinct n-gram of a slice: bounded by SLICE.
    return told.groupBy("slice").agg(F.collect_list(F.struct("segment", "levels")).alias("answers"))
