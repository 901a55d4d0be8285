"""A Merkle manifest of the documents with a proof for every row, by pointer jumping.

1. Each row's digest is a leaf. Leaves are numbered within their source by
   doc_id, in parallel (range partitions and offsets, no window over a source).
2. Level by level, ``ARITY`` consecutive nodes become the digest of their
   digests, until one subroot a source is left; the subroots, ordered by
   source, form the top tree in the same way. Every family (a parent and its
   children) is stored.
3. Every node points to its parent and holds the segment of siblings on the
   way there. A self-join replaces the pointer by the parent's pointer and
   joins the segments, so each round doubles the distance; after
   log2(height) rounds every leaf points to the root and holds its proof.
   From a distance of 8 on, many leaves share an ancestor: those joins are
   salted, so a source with a third of all rows spreads over tasks.

``verify`` folds a changed leaf with the stored siblings again.

Defined results: a null in any column enters its leaf as ``-``; rows without a
source form a source of their own, the first one; rows without a doc_id come
first in their source; rows that share a doc_id ascend by leaf; other columns
are ignored; an empty table has no rows and no root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.operators.keys import assign_ids

ARITY = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # the tree above the sources'
SALTS, FAR = 64, 8  # so many salts, from this distance on
BROADCAST_SOURCES = 100_000  # rows of (source, four numbers)
HEIGHTS = [ARITY ** k for k in range(39)]  # up to the largest long


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of the values, each with its length in front."""

    def part(v: Column) -> Column:
        v = v.cast("string")
        return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))

    return digest(F.concat(*[part(v) for v in values]))


def height(n: Column) -> Column:
    """Levels above ``n`` leaves: the powers of ARITY below n."""
    return F.size(F.filter(F.array(*[F.lit(h) for h in HEIGHTS]), lambda h: h < n))


@dataclass
class Manifest:
    leaves: DataFrame  # the rows with tree, idx, leaf
    sources: DataFrame  # tree, source, height, first, subroot
    families: list[DataFrame]  # tree, level, idx (of the parent), hash, kids
    root: str | None


def grow(level: DataFrame, name: str) -> list[DataFrame]:
    """The families above ``level`` (tree, height, level, idx, hash), lowest first."""
    out = []
    while True:
        kids = F.sort_array(F.collect_list(F.struct((F.col("idx") % ARITY).cast("int").alias("at"), "hash")))  # ARITY at most
        family = level.filter("level < height").groupBy("tree", "height", "level", F.expr(f"idx div {ARITY}").alias("parent")).agg(
            kids.alias("kids"))
        family = stored(family.select("tree", "height", (F.col("level") + 1).alias("level"), F.col("parent").alias("idx"),
                                      digest(F.array_join("kids.hash", "")).alias("hash"), "kids"), name)
        if family.isEmpty():
            return out
        out.append(family)
        level = family.drop("kids")


def build(docs: DataFrame, leaf: Column, carry: dict[str, Column] | None = None) -> Manifest:
    """The trees over ``docs``; ``carry`` are further columns the leaves keep."""
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       leaf.alias("leaf"), *[c.alias(k) for k, c in (carry or {}).items()])
    ranked = stored(assign_ids(rows, ["source", "doc_id", "leaf"], -1, "rank"), "leaves")
    counted = ranked.groupBy("source").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = stored(assign_ids(counted, ["source"], -1, "tree").withColumn("height", height(F.col("n"))), "sources")
    n_sources = sources.count()
    side = sources.withColumnRenamed("source", "of").drop("n")
    side = F.broadcast(side) if n_sources <= BROADCAST_SOURCES else side
    leaves = stored(ranked.join(side, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "idx", F.col("rank") - F.col("first")).drop("of", "rank", "first"), "leaves")

    families = grow(leaves.select("tree", "height", F.lit(0).alias("level"), "idx", F.col("leaf").alias("hash")), "families")
    tops = leaves.filter("height = 0").select("tree", F.col("leaf").alias("subroot"))
    for f in families:
        tops = tops.union(f.filter("level = height").select("tree", F.col("hash")))
    sources = stored(sources.join(tops, "tree"), "sources")
    above = grow(sources.select(F.lit(TOP).cast("bigint").alias("tree"), height(F.lit(n_sources)).alias("height"),
                                F.lit(0).alias("level"), F.col("tree").alias("idx"), F.col("subroot").alias("hash")), "top")
    last = above[-1] if above else sources.select(F.col("subroot").alias("hash"))
    root = last.first()
    return Manifest(leaves, sources, families + above, root["hash"] if root else None)


def proofs(m: Manifest) -> DataFrame:
    """(tree, idx, path): for each leaf with ancestors the siblings, as bytes
    left and right of its own branch, level by level up to the root."""
    edges = None
    for f in m.families:
        hashes = F.transform("kids", lambda k: F.unhex(k["hash"]))
        steps = f.select("tree", "level", "idx", "height", F.posexplode("kids").alias("k", "kid"), hashes.alias("hashes"))

        def joined(some: Column) -> Column:
            return F.aggregate(some, F.lit(b""), lambda acc, x: F.concat(acc, x))

        steps = steps.select(
            node("tree", F.col("level") - 1, F.col("idx") * ARITY + F.col("k"), "height").alias("node"),
            node("tree", F.col("level"), F.col("idx"), "height").alias("to"),
            F.array(F.struct(joined(F.slice("hashes", F.lit(1), F.col("k"))).alias("left"),
                             joined(F.slice("hashes", F.col("k") + 2, F.lit(ARITY))).alias("right"))).alias("path"))
        edges = steps if edges is None else edges.union(steps)
    if edges is None:
        return m.leaves.sparkSession.createDataFrame([], "tree bigint, idx bigint, path array<struct<left: binary, right: binary>>")
    now, distance = stored(edges, "pointers"), 1
    while True:
        # No pointer leads to a source's leaves.
        ahead = now.filter(at_step(distance) & ((F.col("node.tree") == TOP) | (F.col("node.level") > 0))).select(
            F.col("node").alias("to"), F.col("to").alias("far"), F.col("path").alias("more"))
        on = ["to"]
        left = now.filter(at_step(2 * distance))
        if distance >= FAR:
            on.append("salt")
            ahead = ahead.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            left = left.withColumn("salt", (F.col("node.idx") % SALTS).cast("int"))
        step = left.join(ahead, on, "left").select(
            "node", F.coalesce("far", "to").alias("to"),
            F.when(F.col("more").isNotNull(), F.concat("path", "more")).otherwise(F.col("path")).alias("path"),
            F.col("far").isNotNull().alias("moved"))
        step = stored(step, "pointers")
        now, distance = step.drop("moved"), 2 * distance
        if not step.filter("moved").limit(1).count():
            break
    # A source of one leaf starts in the top tree.
    own = now.filter((F.col("node.tree") != TOP) & (F.col("node.level") == 0)).select("node.tree", "node.idx", "path")
    lone = now.filter((F.col("node.tree") == TOP) & (F.col("node.level") == 0)).select(F.col("node.idx").alias("tree"), "path")
    lone = lone.join(m.sources.filter("height = 0").select("tree"), "tree").select("tree", F.lit(0).cast("bigint"), "path")
    return own.union(lone)


def node(tree: str, level: Column, idx: Column, height: str) -> Column:
    """A node's name; a source's subroot is a leaf of the top tree."""
    sub = (F.col(tree) != TOP) & (level == F.col(height))
    return F.struct(F.when(sub, F.lit(TOP)).otherwise(F.col(tree)).cast("bigint").alias("tree"),
                    F.when(sub, F.lit(0)).otherwise(level).cast("int").alias("level"),
                    F.when(sub, F.col(tree)).otherwise(idx).cast("bigint").alias("idx"))


def at_step(distance: int) -> Column:
    """Nodes that leaves can stand at after steps of ``distance``; in the top
    tree, which leaves enter from different heights, any."""
    return (F.col("node.tree") == TOP) | (F.col("node.level") % distance == 0)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda acc, s: digest(F.concat(F.lower(F.hex(s["left"])), acc, F.lower(F.hex(s["right"])))))


def path_digest(path: Column) -> Column:
    """Digest of all siblings in order, as hex text."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(F.lower(F.hex(s["left"])), F.lower(F.hex(s["right"])))), ""))


def verify(docs: DataFrame, tampered: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for
    every row: its proof, folded from the leaf that the row has after
    ``tampered`` replaces columns."""
    changed = [(tampered or {}).get(c, F.col(c)) for c in COLUMNS]
    m = build(docs, leaf_digest([F.col(c) for c in COLUMNS]), {"now": leaf_digest(changed)})
    side = m.sources.select("tree", "subroot")
    side = F.broadcast(side) if side.count() <= BROADCAST_SOURCES else side
    none = F.array().cast("array<struct<left: binary, right: binary>>")
    out = m.leaves.join(proofs(m), ["tree", "idx"], "left").withColumn("path", F.coalesce("path", none)).join(side, "tree")
    root = F.lit(m.root)
    out = out.select("doc_id", "leaf", "subroot", root.alias("root"), path_digest(F.col("path")).alias("proof_sha256"),
                     fold(F.col("now"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def even_crc(doc_id: str = "doc_id") -> Column:
    """Whether 2 divides the crc32 of the decimal doc_id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0, F.lit(False))


def without_line_ends(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, where every second document (by crc32) has lost the
    line ends of its text since the manifest was made."""
    text = F.col("text").cast("string")
    return verify(docs, {"text": F.when(even_crc(), F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)})
