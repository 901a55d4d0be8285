"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

1. One pass over the texts gives each document its distinct word shingles
   (as 64-bit hashes), a digest of that set, MinHash samples folded into band
   keys, and an odd sketch: a bitmap in which every MinHash sample flips one
   bit, so that the XOR of two sketches counts the samples that differ.
2. Documents with equal sets form a class; only one representative of each
   goes on, so thousands of exact copies cost one row.
3. Bands with two or more representatives give candidate pairs, in three
   rounds. First each representative is paired with the one band centre
   (smallest id in a shared band) whose sketch is nearest. Then, band by band
   in blocks, with the nearest sketch in another component. Last, whatever
   bands and sketches still connect across components forms clusters, and in
   each, block by block, every pair that sketches and set sizes allow.
   Sketches only discard pairs whose estimate lies ``SIGMAS`` standard errors
   below the threshold. No round emits more pairs than it reads rows.
4. Each pair is confirmed on its full sets before it counts as a link.
5. Connected components over the links; the smallest doc_id names each.

A pair between documents that are already connected needs no check: it
cannot change a component. Everything else found is confirmed, without a cap.

Defined results: null or wordless text has no shingles and links with
nothing; a text of fewer than ``width`` words is one shingle; rows that share
a doc_id are one document, which is linked with whatever any of its texts is
linked with (a row without words stays by itself); other columns are ignored.
``keep_one`` goes by texts: it removes a text only where a linked one stays.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, text_bytes
from ledgerline.llm.components import components
from ledgerline.llm.shingles import mix, shingle_sets

SAMPLES = 120  # MinHash samples per document
SKETCH_WORDS = 8  # odd sketch of 8 x 64 bits
SIGMAS = 5.0
BLOCK_ROWS = 4096  # rows of one band whose sketches are compared with as many others at a time
TEXT_ROWS = 512  # the same where whole texts are compared
MISS = 2e-6  # highest chance that a pair at the threshold shares no band


@dataclass(frozen=True)
class Rule:
    """``width`` words a shingle; linked if 100 * common >= percent * union."""
    width: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        """Samples in a band: the most that keep a pair at the threshold from being missed."""
        j = self.percent / 100
        fits = [r for r in range(1, 31) if SAMPLES % r == 0 and (1 - j**r) ** (SAMPLES // r) <= MISS]
        return max(fits, default=1)

    @property
    def most_bits(self) -> int:
        """Most differing sketch bits of a pair that may reach the threshold."""
        j = self.percent / 100
        differ = SAMPLES * (1 - j) + SIGMAS * math.sqrt(SAMPLES * j * (1 - j))
        bits = 64 * SKETCH_WORDS
        return math.ceil(bits * (1 - (1 - 2 / bits) ** (2 * min(differ, SAMPLES))) / 2 + 3)


_rng = np.random.default_rng(11)
_mul = (_rng.integers(0, 2**31, SAMPLES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_add = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint32)


def minhash(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, SAMPLES) smallest values; rows of empty sets are all ones."""
    n = len(at) - 1
    out = np.full((n, SAMPLES), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        x = (mix(sets) >> np.uint64(32)).astype(np.uint32)
        for j in range(SAMPLES):
            v = x * _mul[j] + _add[j]
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            out[some, j] = np.minimum.reduceat(v, at[some])
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """(texts, SKETCH_WORDS) bitmaps: every (sample number, value) flips a bit."""
    h = mix(samples.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)))
    bit = h % np.uint64(64 * SKETCH_WORDS)
    word, one = bit >> np.uint64(6), np.uint64(1) << (bit & np.uint64(63))
    return np.stack([np.bitwise_xor.reduce(np.where(word == w, one, np.uint64(0)), axis=1)
                     for w in range(SKETCH_WORDS)], axis=1)


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    bands = SAMPLES // rows
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(samples), bands)).copy()
    cells = samples.reshape(len(samples), bands, rows).astype(np.uint64)
    for j in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, j] + np.uint64(1))
    return key


SIGNATURE = "doc_id bigint, text_hash bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>, sketch array<bigint>"


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)),
                                    pa.array(rows.view(np.int64).ravel()))


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per document: set size, set digest, band keys and sketch."""
    width, rows = rule.width, rule.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                part = whole.slice(k, 1024)
                sets, at = shingle_sets(*text_bytes(part.column(1)), width)
                samples = minhash(sets, at)
                some, n = np.flatnonzero(np.diff(at)), np.diff(at)
                digest = np.zeros((2, len(n)), np.uint64)
                if len(some):
                    digest[0, some] = np.add.reduceat(mix(sets), at[some])
                    digest[1, some] = np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), at[some])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)),
                     _lists(band_keys(samples, rows)), _lists(odd_sketch(samples))],
                    names=["doc_id", "text_hash", "n", "d1", "d2", "bands", "sketch"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(run, SIGNATURE)


def sketch_bits(a: str, b: str):
    """Differing bits of two sketch columns."""
    return sum((F.bit_count(F.col(a)[w].bitwiseXOR(F.col(b)[w])) for w in range(SKETCH_WORDS)), F.lit(0))


def _sizes_allow(small, large, rule: Rule):
    return F.least(small, large) * 100 >= F.greatest(small, large) * rule.percent


def in_blocks(rows: DataFrame, key: str, size: int, run_group: Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray],
              columns: list[str], out: list[str]) -> DataFrame:
    """Compare the rows of each ``key`` block by block.

    A key's rows are dealt to blocks of about ``size``; ``run_group`` gets the
    rows of two blocks (or of one), and the indices of either side, and
    returns its result columns (bigint). No task ever holds a whole key."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("m"))
    nb = F.ceil(F.col("m") / size)
    dealt = rows.join(counts, key).withColumn("own", F.pmod(F.xxhash64("rep"), nb))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), (nb - 1).cast("bigint"))))
    dealt = dealt.select(F.col(key).alias("key"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         "own", *columns)
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def group(t: pa.Table) -> pa.RecordBatch:
        i, j, own = t.column("i")[0].as_py(), t.column("j")[0].as_py(), t.column("own").to_numpy()
        found = run_group(t, np.flatnonzero(own == i), np.flatnonzero(own == j))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                part = pa.Table.from_batches([batch.slice(s, e - s)])
                if held and any(held[0].column(c)[0] != part.column(c)[0] for c in ("key", "i", "j")):
                    yield group(pa.concat_tables(held))
                    held = []
                held.append(part)
        if held:
            yield group(pa.concat_tables(held))

    return dealt.mapInArrow(run, ", ".join(f"{c} bigint" for c in out))


class _Group:
    """The rows of one comparison as arrays."""

    def __init__(self, t: pa.Table, rule: Rule):
        self.rep, label, self.n = (t.column(c).to_numpy() for c in ("rep", "label", "n"))
        self.sketch = t.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_WORDS)
        self.label = np.unique(label, return_inverse=True)[1]
        self.part = self.label.copy()  # rows known to be connected
        self.most, self.percent = rule.most_bits, rule.percent

    def near(self, p: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of q with another label, not connected with p, that sizes
        and sketches allow, and their differing bits."""
        q = q[(self.part[q] != self.part[p]) & (self.label[q] != self.label[p]) & (self.rep[q] != self.rep[p])]
        q = q[np.minimum(self.n[q], self.n[p]) * 100 >= np.maximum(self.n[q], self.n[p]) * self.percent]
        bits = np.bitwise_count(self.sketch[q] ^ self.sketch[p]).sum(axis=1)
        return q[bits <= self.most], bits[bits <= self.most]

    def join(self, p: int, q: np.ndarray) -> np.ndarray:
        """Connect p with q; of each part that is new to p one row is returned."""
        parts, first = np.unique(self.part[q], return_index=True)
        self.part[np.isin(self.part, parts)] = self.part[p]
        return q[first]


def nearest_partners(rows: DataFrame, rule: Rule) -> DataFrame:
    """(rep, bits, partner): for each row of a band (``band``, ``rep``,
    ``label``, ``n``, ``sketch``) its nearest sketch with another label in each
    block that it is compared with: as many rows as it reads at most."""
    def run(t: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        g, found = _Group(t, rule), []
        for side, other in ((left, right), (right, left))[:1 if left is right or np.array_equal(left, right) else 2]:
            for p in side:
                q, bits = g.near(p, other)
                if len(q):
                    k = np.lexsort((g.rep[q], bits))[0]
                    found.append((g.rep[p], bits[k], g.rep[q[k]]))
        return np.array(found, np.int64).reshape(-1, 3).T

    return in_blocks(rows, "band", BLOCK_ROWS, run, ["rep", "label", "n", "sketch"], ["rep", "bits", "partner"])


def stars(rows: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): each row's smallest and largest of the band centres that it is
    near to. A band has two, its first row by label and its last, so every
    row of a band with several labels meets one of another label. At most two
    edges for each row, however many bands it is in."""
    row = F.struct("label", "rep", "n", "sketch")
    ends = rows.groupBy("band").agg(F.min(row).alias("lo"), F.max(row).alias("hi"))
    both = rows.join(ends, "band").select("rep", "label", "n", "sketch", F.explode(F.array("lo", "hi")).alias("c"))
    both = both.select("rep", "n", "sketch", F.col("c.rep").alias("centre"), F.col("c.n").alias("cn"), F.col("c.sketch").alias("cs"),
                       (F.col("label") != F.col("c.label")).alias("apart"))
    near = both.filter(F.col("apart") & _sizes_allow(F.col("n"), F.col("cn"), rule) & (sketch_bits("sketch", "cs") <= rule.most_bits))
    of = near.groupBy("rep").agg(F.min("centre").alias("lo"), F.max("centre").alias("hi"))
    return stored(of.select(F.explode(F.array("lo", "hi")).alias("a"), F.col("rep").alias("b")), "stars")


def clusters(rows: DataFrame, rule: Rule) -> DataFrame:
    """(node, cluster): rows that a band and sketches connect across labels.
    Stars connect most of a large group. Then the bands that still hold
    several parts are compared whole; each comparison returns a spanning
    forest of the parts it meets, so fewer edges than parts."""
    def run(t: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        g, found, part = _Group(t, rule), [], t.column("part").to_numpy()
        g.part = np.unique(part, return_inverse=True)[1]  # rows of one label too need an edge
        for p in left:
            q, _ = g.near(p, right)
            if len(q):
                found += [(part[p], x) for x in part[g.join(p, q)]]
        return np.array(found, np.int64).reshape(-1, 2).T

    star = components(stars(rows, rule)).select(F.col("node").alias("rep"), F.col("label").alias("part"))
    parts = rows.join(star, "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    mixed = parts.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("band")
    parts = stored(parts.join(mixed, "band"), "parts")
    edges = in_blocks(parts, "band", BLOCK_ROWS, run, ["rep", "label", "n", "sketch", "part"], ["a", "b"])
    whole = components(edges).withColumnRenamed("node", "part")
    nodes = star.union(whole.select(F.col("part").alias("rep"), "part")).distinct()  # a part outside the stars is one row
    return nodes.join(whole, "part", "left").select(F.col("rep").alias("node"), F.coalesce("label", "part").alias("cluster"))


def confirm_all(rows: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): links between the labels of each cluster (``cluster``, ``rep``,
    ``label``, ``n``, ``sketch``), confirmed on full sets where they are
    compared: every pair that sketches allow, unless already connected."""
    width, percent = rule.width, rule.percent

    def run(t: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        g, found = _Group(t, rule), []
        sets, at = shingle_sets(*text_bytes(t.column("text").combine_chunks()), width)
        for p in left:
            q, _ = g.near(p, right)
            own = sets[at[p]:at[p + 1]]
            if not len(q) or not len(own):
                continue
            others = [sets[at[k]:at[k + 1]] for k in q]
            x, sizes = np.concatenate(others), np.array([len(o) for o in others])
            hit = own[np.minimum(np.searchsorted(own, x), len(own) - 1)] == x
            total = np.concatenate([[0], np.cumsum(hit)])
            end = np.cumsum(sizes)
            common = total[end] - total[end - sizes]
            linked = q[(common > 0) & (100 * common >= percent * (sizes + len(own) - common))]
            if len(linked):
                found += [(g.rep[p], k) for k in g.rep[g.join(p, linked)]]
        return np.array(found, np.int64).reshape(-1, 2).T

    texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), F.col("text").cast("string").alias("text"))
    # The texts stream past the ids: a hash table of ids, no sort of texts.
    full = stored(texts.join(rows.hint("shuffle_hash"), "rep"), "cluster-texts")
    return stored(in_blocks(full, "cluster", TEXT_ROWS, run, ["rep", "label", "n", "sketch", "text"], ["a", "b"]).distinct(), "links")


def confirm(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    width, percent = rule.width, rule.percent
    pairs = stored(pairs.select("a", "b"), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string").alias("text"))
    # The texts stream past the ids: a hash table of ids, no sort of texts.
    texts = stored(texts.join(ends.hint("shuffle_hash"), "node").distinct(), "pair-texts")
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                part = whole.slice(k, 256)
                (sa, at), (sb, bt) = (shingle_sets(*text_bytes(part.column(c)), width) for c in ("text_a", "text_b"))
                keep = []
                for i in range(part.num_rows):
                    x, y = sa[at[i]:at[i + 1]], sb[bt[i]:bt[i + 1]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if common and 100 * common >= percent * (len(x) + len(y) - common):
                        keep.append(i)
                rows = part.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([rows.column("a"), rows.column("b")], names=["a", "b"])

    return stored(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint").distinct(), "links")


DIGEST = ["d1", "d2", "n"]


def search(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' signatures, the classes of equal sets with their
    representatives, and confirmed links (a, b) between representatives that
    connect all that is linked."""
    sig = stored(signatures(docs, rule), "signatures")
    reps = stored(sig.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*DIGEST).agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
    nodes = reps.select("rep", "n", "sketch")

    banded = reps.select("rep", F.explode("bands").alias("band")).distinct()
    centres = banded.groupBy("band").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).filter("centre < last")
    shared = stored(banded.join(centres.select("band", "centre"), "band"), "bands")

    # Round 1: each representative with its best band centre.
    star = shared.filter("rep > centre").select("rep", "centre").distinct()
    star = (star.join(nodes.select("rep", "n", F.col("sketch").alias("s")), "rep")
            .join(nodes.select(F.col("rep").alias("centre"), F.col("n").alias("cn"), F.col("sketch").alias("cs")), "centre"))
    star = star.select("rep", "centre", sketch_bits("s", "cs").alias("bits"), "n", "cn")
    star = star.filter((F.col("bits") <= rule.most_bits) & _sizes_allow(F.col("n"), F.col("cn"), rule))
    best = star.groupBy("rep").agg(F.min(F.struct("bits", "centre")).alias("best"))
    links = confirm(best.select(F.col("best.centre").alias("a"), F.col("rep").alias("b")), docs, rule)
    labels = components(links)

    def apart() -> DataFrame:
        """The bands that still hold more than one label, with what their rows need to be compared."""
        labelled = shared.select("rep", "band").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
            "rep", "band", F.coalesce("label", "rep").alias("label"))
        mixed = labelled.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
        return stored(labelled.join(mixed.select("band"), "band").join(nodes, "rep"), "apart")

    # Round 2: each representative with its nearest sketch in another component.
    near = nearest_partners(apart(), rule).groupBy("rep").agg(F.min(F.struct("bits", "partner")).alias("best"))
    links = links.union(confirm(near.select(F.least("rep", "best.partner").alias("a"), F.greatest("rep", "best.partner").alias("b")
                                            ).distinct(), docs, rule))
    labels = components(links)

    # Round 3: every pair left, so that no link is missed.
    rows = apart()
    of = clusters(rows, rule).withColumnRenamed("node", "rep")
    rows = rows.select("rep", "label", "n", "sketch").distinct().join(of, "rep")
    return sig, reps, links.union(confirm_all(rows, docs, rule))


def labelled(sig: DataFrame, reps: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of ``sig`` with the smallest document that they are connected with by ``links``."""
    labels = components(links)
    classes = reps.select(*DIGEST, "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        *DIGEST, F.coalesce("label", "rep").alias("label"))
    return sig.select("doc_id", "text_hash", *DIGEST).join(classes, DIGEST, "left").withColumn("label", F.coalesce("label", "doc_id"))


def by_document(sig: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b): each document of several texts with the representatives of their classes."""
    rows = sig.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", *DIGEST)
    sets = F.struct(*DIGEST)
    several = rows.groupBy("doc_id").agg(F.min(sets).alias("lo"), F.max(sets).alias("hi")).filter("lo < hi").select("doc_id")
    edges = rows.join(several, "doc_id").distinct().join(reps.select("rep", *DIGEST), DIGEST)
    return edges.filter("rep < doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    sig, reps, links = search(docs, rule)
    out = labelled(sig, reps, links.union(by_document(sig, reps)))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("label").alias("component_id"),
                      F.col("doc_id").eqNullSafe(F.col("label")).alias("kept"))


def keep_one(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group of linked
    texts the one with the smallest doc_id stays, with all its columns. Rows
    with equal doc_id and text stay or go together; rows without a doc_id stay.
    A doc_id with several texts does not link them here: a text goes only
    where one that it is connected with by links stays."""
    rows = labelled(*search(docs, rule))
    gone = rows.filter("doc_id <> label").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_text")).distinct()
    same = (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["gone_text"])
    return docs.join(gone, same, "left_anti")
