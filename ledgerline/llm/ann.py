"""Nearest neighbours with an inverted multi-index.

Vectors are cut in two halves, each quantised by its own codebook, so a cell
of the index is a pair of centroids. A query walks the cells by the sum of
its squared distances to the two centroids, smallest first, with a heap over
the two sorted lists, until the cells hold enough vec_ids; the entries of
the visited cells are then reranked by the exact Euclidean distance.

A vec_id may have many rows. Equal rows are indexed once, and a walk counts
a vec_id only in its first cell, so the cells visited hold at least as many
different vec_ids as were counted, however often one repeats.

How many vec_ids are enough is measured: for a bounded sample of the queries
the true neighbours (different vec_ids) are found by brute force over all
rows, and the number is the smallest that reaches ``RECALL`` on that sample.

The codebooks are fitted on a bounded sample; every row is indexed. Cells
that lie near each other are packed into blocks of at most ``BLOCK`` entries
by cutting their centroid pairs at weighted medians (a hot cell is dealt to
several blocks), so a walk over near cells touches few blocks. A task
compares one block with at most ``BLOCK`` queries.

Defined results: vectors that are null, zero, hold a null or non-finite
component, or have another length than the commonest (of equally common
ones the longest) take no part; rows that repeat a vec_id count once per
query, with their smallest distance; rows without a vec_id take no part;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

NEIGHBOURS = 10
SAMPLE = 20_000  # about so many vectors fit the codebooks
CENTROIDS = 1024  # per half at most; they grow with the table up to 16 million rows, then cells do
CELL = 16  # about so many entries a cell, until CENTROIDS is reached
TESTED = 100  # about so many queries measure recall
RECALL = 0.96  # on the tested queries; leaves room above 0.9
BLOCK = 1024


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["size"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] + (c**2).sum(1)[None] - 2 * x @ c.T, 0)


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means centroids of a sample, from evenly spread starting rows."""
    x = x[np.lexsort(x.T)]
    c = np.unique(x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)], axis=0)
    for _ in range(rounds):
        near = squared(x, c).argmin(1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def walk(da: np.ndarray, db: np.ndarray, counts: np.ndarray, enough: float, ids: np.ndarray | None = None) -> list[int]:
    """Cells (row * columns + column) in order of da + db until they hold
    ``enough`` of ``ids`` (without it, entries); equal sums all belong."""
    ids = counts if ids is None else ids
    ia, ib = np.argsort(da, kind="stable"), np.argsort(db, kind="stable")
    heap, cells, held, last = [(da[ia[0]] + db[ib[0]], 0, 0)], [], 0, -1.0
    while heap:
        s, i, j = heapq.heappop(heap)
        if held >= enough and s > last:
            break
        cell = int(ia[i]) * len(db) + int(ib[j])
        if counts[cell]:
            cells.append(cell)
            held += ids[cell]
        last = s
        if j + 1 < len(ib):
            heapq.heappush(heap, (da[ia[i]] + db[ib[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(ia):
            heapq.heappush(heap, (da[ia[i + 1]] + db[ib[0]], i + 1, 0))
    return cells


class Index:
    """Codebooks and cell sizes: small whatever the number of rows."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b, self.half = a, b, a.shape[1]
        self.counts = np.zeros(len(a) * len(b), np.int64)
        self.ids = np.zeros(len(a) * len(b), np.int64)  # vec_ids by their first cell

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(x[:, :self.half], self.a), squared(x[:, self.half:], self.b)

    def cells(self, x: np.ndarray) -> np.ndarray:
        da, db = self.halves(x)
        return da.argmin(1) * len(self.b) + db.argmin(1)

    def layout(self) -> tuple[np.ndarray, np.ndarray]:
        """First block and number of blocks of each cell: small cells that
        lie near each other share one."""
        parts = np.maximum(1, -(-self.counts // BLOCK))
        first = np.zeros(len(self.counts), np.int64)
        blocks = 0
        for cells in self.groups(np.flatnonzero((self.counts > 0) & (parts == 1))):
            first[cells] = blocks
            blocks += 1
        big = np.flatnonzero(parts > 1)
        first[big] = blocks + np.cumsum(parts[big]) - parts[big]
        return first, parts

    def groups(self, cells: np.ndarray) -> Iterator[np.ndarray]:
        """``cells`` in groups of at most BLOCK entries: whatever holds more
        is cut in two at the weighted median of the coordinate that varies most."""
        left = [cells] if len(cells) else []
        while left:
            cells = left.pop()
            weight = self.counts[cells]
            if len(cells) == 1 or weight.sum() <= BLOCK:
                yield cells
                continue
            at = cells // len(self.b), cells % len(self.b)
            spread = [_variances(book, place, weight) for book, place in zip((self.a, self.b), at, strict=True)]
            side = int(spread[1].max(initial=-1) > spread[0].max(initial=-1))
            order = np.argsort((self.a, self.b)[side][at[side], spread[side].argmax()], kind="stable")
            cut = int(np.searchsorted(np.cumsum(weight[order]), weight.sum() / 2)) + 1
            cut = min(cut, len(cells) - 1)
            left += [cells[order[cut:]], cells[order[:cut]]]


def _variances(book: np.ndarray, place: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Variance of each coordinate of the centroids ``place``, weighted."""
    used, at = np.unique(place, return_inverse=True)
    share = np.bincount(at, weights=weight) / weight.sum()
    x = book[used]
    return share @ (x - share @ x) ** 2


def assigned(rows: DataFrame, index: Index) -> DataFrame:
    """(vec_id, v, cell, turn): ``turn`` deals a cell's rows to its blocks."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for b in batches:
            if b.num_rows:
                cells = np.concatenate([shared.value.cells(_matrix(b.column(1).slice(k, 4096))) for k in range(0, b.num_rows, 4096)])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cells),
                                                  pa.array(np.arange(at, at + b.num_rows))], names=["vec_id", "v", "cell", "turn"])
                at += b.num_rows

    return rows.mapInArrow(run, "vec_id bigint, v array<double>, cell bigint, turn bigint")


def exact(queries: np.ndarray, entries: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Euclidean distances of (query, entry) pairs, from the differences."""
    out = np.empty(len(pairs[0]))
    for k in range(0, len(out), 1 << 15):
        d = queries[pairs[0][k:k + (1 << 15)]] - entries[pairs[1][k:k + (1 << 15)]]
        out[k:k + (1 << 15)] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


def build(rows: DataFrame) -> tuple[Index, DataFrame]:
    """The index of ``rows`` (vec_id, v) and its stored entries, equal rows once."""
    n = rows.select("vec_id", F.xxhash64("v").alias("h")).distinct().count()
    part = rows.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1_000_000)) < min(1.0, SAMPLE / max(n, 1)) * 1_000_000)
    table = part.dropDuplicates(["vec_id", "v"]).select("v").toArrow().column("v").combine_chunks() if n else None
    x = _matrix(table if isinstance(table, pa.Array) else table.chunk(0)) if table is not None and len(table) else None
    if x is None or not len(x):
        head = rows.select("v").limit(256).collect()
        x = np.array([r["v"] for r in head])
    half = max(1, x.shape[1] // 2)
    k = int(min(CENTROIDS, max(1, 2 ** round(math.log2(max(1, math.sqrt(n / CELL)))))))
    other = x[:, half:] if x.shape[1] > half else np.zeros((len(x), 1))[:, :0]
    index = Index(codebook(x[:, :half], k), codebook(other, k) if other.shape[1] else np.zeros((1, 0)))
    entries = stored(assigned(rows.dropDuplicates(["vec_id", "v"]), index), "ann-entries")
    for r in entries.groupBy("cell").count().collect():  # one row a cell, at most CENTROIDS squared
        index.counts[r["cell"]] = r["count"]
    for r in entries.groupBy("vec_id").agg(F.min("cell").alias("cell")).groupBy("cell").count().collect():
        index.ids[r["cell"]] = r["count"]
    return index, entries


def by_id(vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts rows of one vec_id together, and where each begins."""
    order = np.argsort(vec, kind="stable")
    return order, first_places(vec[order])


def first_places(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def nearest_by_brute_force(entries: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int) -> DataFrame:
    """(q, cell): the cells of the k nearest other vec_ids of a few queries."""
    shared = entries.sparkSession.sparkContext.broadcast((queries, ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, qid = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            order, starts = by_id(b.column(0).to_numpy())
            x, vec = _matrix(b.column(1))[order], b.column(0).to_numpy()[order]
            d = squared(q, x)
            d[qid[:, None] == vec[None]] = np.inf
            m = min(k, len(starts))
            best = np.argpartition(np.minimum.reduceat(d, starts, axis=1), m - 1, axis=1)[:, :m]
            which = np.repeat(np.arange(len(q)), m)
            ends = np.append(starts[1:], len(vec))
            flat = np.array([starts[g] + d[i, starts[g]:ends[g]].argmin() for i, g in zip(which, best.ravel())])
            dist = d[which, flat]
            ok = np.isfinite(dist)
            yield pa.RecordBatch.from_arrays([pa.array(which[ok]), pa.array(dist[ok]), pa.array(vec[flat][ok]),
                                              b.column(2).take(pa.array(order[flat[ok]]))], names=["q", "d", "vec_id", "cell"])

    found = entries.select("vec_id", "v", "cell").mapInArrow(run, "q bigint, d double, vec_id bigint, cell bigint")
    once = found.groupBy("q", "vec_id").agg(F.min(F.struct("d", "cell")).alias("m")).select("q", "vec_id", "m.d", "m.cell")
    order = Window.partitionBy("q").orderBy("d", "vec_id")
    return once.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).select("q", "cell")


def enough_entries(index: Index, entries: DataFrame, queries: DataFrame, k: int) -> int:
    """vec_ids a walk must cover to reach RECALL on sampled queries."""
    each = queries.groupBy("vec_id").agg(F.min("v").alias("v"))  # a vec_id of many rows is tested by one
    n = each.count()
    some = each.filter(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1_000_000)) < min(1.0, TESTED / max(n, 1)) * 1_000_000)
    some = some.select("vec_id", "v").orderBy("vec_id").limit(4 * TESTED).collect() or each.select("vec_id", "v").limit(TESTED).collect()
    if not some:
        return 0
    q, ids = np.array([r["v"] for r in some]), np.array([r["vec_id"] for r in some])
    need = []
    da, db = index.halves(q)
    truth = nearest_by_brute_force(entries, q, ids, k).collect()  # at most 10 rows for each tested query
    by_query: dict[int, list[int]] = {}
    for r in truth:
        by_query.setdefault(r["q"], []).append(r["cell"])
    for i, cells in by_query.items():
        sums = (da[i][:, None] + db[i][None]).ravel()
        order = np.sort(sums)
        held = np.concatenate([[0], np.cumsum(index.ids[np.argsort(sums, kind="stable")])])
        # vec_ids in cells not farther than the neighbour's own, which may be the first of none.
        need += [int(max(held[np.searchsorted(order, sums[c], "right")], held[np.searchsorted(order, sums[c])] + 1)) for c in cells]
    return int(np.quantile(need, RECALL, method="higher")) if need else 0


def visits(queries: DataFrame, shared: Broadcast) -> DataFrame:
    """(block, query_id, q, reach): the blocks that each query's walk touches
    and the largest sum of distances of its cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, first, parts, enough = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            da, db = ix.halves(_matrix(b.column(1)))
            at, blocks, reach = [], [], []
            for i in range(b.num_rows):
                cells = np.array(walk(da[i], db[i], ix.counts, enough, ix.ids), np.int64)
                all_blocks = np.unique(np.concatenate([np.arange(first[c], first[c] + parts[c]) for c in cells]))
                last = cells[-1]
                at.append(np.full(len(all_blocks), i))
                blocks.append(all_blocks)
                reach.append(np.full(len(all_blocks), da[i][last // len(ix.b)] + db[i][last % len(ix.b)]))
                if i + 1 == b.num_rows or sum(map(len, at)) >= BLOCK:  # each visit carries its query
                    pick = pa.array(np.concatenate(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(blocks)), b.column(0).take(pick), b.column(1).take(pick),
                         pa.array(np.concatenate(reach))], names=["block", "query_id", "q", "reach"])
                    at, blocks, reach = [], [], []

    spread = max(1, queries.sparkSession.sparkContext.defaultParallelism)
    return queries.repartition(spread, "vec_id", "v").mapInArrow(
        run, "block bigint, query_id bigint, q array<double>, reach double")


def compared(entries: DataFrame, visited: DataFrame, shared: Broadcast, k: int) -> DataFrame:
    """The k nearest vec_ids of each query among the entries of its cells."""
    # Blocks that many queries visit are compared in parts of the queries.
    load = visited.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("bigint").alias("splits"))
    left = visited.join(load, "block").withColumn("split", F.pmod(F.xxhash64("query_id", "q"), F.col("splits")))

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, first, parts, _ = shared.value
        for b in batches:
            cell, turn = b.column(2).to_numpy(), b.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(first[cell] + turn % parts[cell]), *b.columns[:3]],
                                             names=["block", "vec_id", "v", "cell"])

    right = entries.mapInArrow(blocks_of, "block bigint, vec_id bigint, v array<double>, cell bigint")
    loads = load.select(F.col("block").alias("to_block"), F.col("splits").alias("to_splits"))
    right = right.join(loads, F.col("block") == F.col("to_block")).select(
        "to_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("to_splits") - 1)).alias("to_split"), "vec_id", "v", "cell")

    def compare(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        ix = shared.value[0]
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(entries):
            q, x = np.stack(queries["q"].to_numpy()), np.stack(entries["v"].to_numpy())
            qid, vec, cell = queries["query_id"].to_numpy(), entries["vec_id"].to_numpy(), entries["cell"].to_numpy()
            order, _ = by_id(vec)
            x, vec, cell = x[order], vec[order], cell[order]
            da, db = ix.halves(q)
            for i in range(len(q)):
                sums = da[i][cell // len(ix.b)] + db[i][cell % len(ix.b)]
                at = np.flatnonzero((sums <= queries["reach"].iat[i]) & (vec != qid[i]))
                if not len(at):
                    continue
                near = squared(q[i][None], x[at])[0]
                if len(at) > k:  # the k nearest vec_ids and all that rounding might rank among them
                    starts = first_places(vec[at])
                    least = np.minimum.reduceat(near, starts)
                    cut = np.partition(least, k - 1)[k - 1] if len(least) > k else np.inf
                    cuts = np.minimum(cut, np.repeat(least, np.diff(np.append(starts, len(at)))))
                    at = at[near <= cuts + 1e-6 * (1 + np.abs(cuts))]
                d = exact(q[i][None], x[at], (np.zeros(len(at), int), np.arange(len(at))))
                found["query_id"].append(np.full(len(at), qid[i]))
                found["vec_id"].append(vec[at])
                found["score"].append(d)
        return pd.DataFrame({c: np.concatenate(v) if v else np.array([], float if c == "score" else int)
                             for c, v in found.items()})

    near = left.groupBy("block", "split").cogroup(right.groupBy("to_block", "to_split")).applyInPandas(
        compare, "query_id bigint, vec_id bigint, score double")
    once = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, every: int = 100, k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row
    whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if rows.isEmpty():
        return spark.createDataFrame([], result)
    index, entries = build(rows)
    queries = entries.filter(F.col("vec_id") % every == 0).select("vec_id", "v").dropDuplicates(["vec_id", "v"])
    enough = enough_entries(index, entries, queries, k)
    shared = spark.sparkContext.broadcast((index, *index.layout(), max(enough, 4 * k)))
    return compared(entries, stored(visits(queries, shared), "ann-visits"), shared, k)
