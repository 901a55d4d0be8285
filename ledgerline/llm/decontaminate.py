"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is contained in a document if at least ``percent`` of the item's
distinct word shingles occur in the document, however long the document is.
Items are partitioned by size (powers of two of their shingle count). The
MinHash sample of an item is its smallest shingle hashes; its size depends on
the partition: one more than the most shingles a contained item of the
partition may miss. So a document that contains an item shares at least one
sample with it, and the search misses nothing. Documents' shingles are joined
with the samples while the texts are scanned, and a document that shares a
sample is compared with the item's whole shingle set on the spot.

The benchmark is broadcast in blocks of at most ``BLOCK_SHINGLES`` shingles
(counted first), one scan of the documents for each block.

Defined results: items with fewer than ``width`` words, null or empty are
too short to be recognised and match nothing; null texts contain nothing;
repeated rows are reported once per (doc_id, item_id), with the largest
containment; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BLANKS

WIDTH = 5
PERCENT = 80
BLOCK_SHINGLES = 1_000_000  # 8 bytes each, and as many bytes of samples at most


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BLANKS), "")


def with_shingles(df: DataFrame, width: int) -> DataFrame:
    """(id, text) -> (id, shingles): distinct hashes of all runs of ``width`` words."""
    words = df.select("id", word_array(F.col("text")).alias("words"))
    hashed = words.select("id", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    h = F.col("h")
    runs = F.transform(F.slice("h", 1, F.greatest(F.size("h") - (width - 1), F.lit(0))), lambda first, i: F.xxhash64(
        first, *[F.get(h, i + k) for k in range(1, width)]))
    return hashed.select("id", F.array_distinct(runs).alias("shingles"))


def item_table(benchmark: DataFrame, width: int, percent: int) -> DataFrame:
    """(item_id, n_item, shingles, samples) of the items long enough."""
    items = with_shingles(benchmark.select(F.col("item_id").cast("bigint").alias("id"), "text"), width)
    items = items.select(F.col("id").alias("item_id"), F.array_sort("shingles").alias("shingles"))
    items = items.filter((F.size("shingles") > 0) & F.col("item_id").isNotNull())
    n = F.size("shingles")
    partition = F.floor(F.log2(n.cast("double")) + 1e-9).cast("int")
    largest = F.call_function("shiftleft", F.lit(2), partition) - 1  # of the partition
    # A contained item of size s misses at most floor(s * (100 - percent) / 100).
    sample = F.floor(largest * (100 - percent) / 100).cast("int") + 1
    return items.select("item_id", n.alias("n_item"), "shingles", F.slice("shingles", F.lit(1), sample).alias("samples"))


def containment_pairs(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT,
                      block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, item_id, n_item, n_common, containment) of every document
    that contains a benchmark item."""
    items = item_table(benchmark, width, percent)
    total = items.agg(F.coalesce(F.sum("n_item"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_shingles))
    grams = with_shingles(docs.select(F.col("doc_id").cast("bigint").alias("id"), "text"), width)
    out = None
    for k in range(blocks):
        some = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else items
        samples = some.select("item_id", F.explode_outer("samples").alias("gram"))
        sets = some.select("item_id", "n_item", F.col("shingles").alias("item_shingles"))
        # The outer form: the plain one adds a filter that tokenises once more for each word.
        each = grams.select("id", "shingles", F.explode_outer("shingles").alias("gram"))
        near = each.join(F.broadcast(samples), "gram").join(F.broadcast(sets), "item_id")
        common = F.size(F.array_intersect("item_shingles", "shingles"))
        near = near.select(F.col("id").alias("doc_id"), "item_id", "n_item", common.alias("n_common"))
        near = near.filter(F.col("n_common") * 100 >= F.col("n_item") * percent)
        out = near if out is None else out.unionByName(near)
    out = out.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_common") / F.col("n_item"), "n_item", "n_common")).alias("m"))
    return out.select("doc_id", "item_id", F.col("m.n_item").cast("bigint").alias("n_item"),
                      F.col("m.n_common").cast("bigint").alias("n_common"), F.col("m.col1").alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item, with all
    their columns; rows without a doc_id stay."""
    leaks = containment_pairs(docs, benchmark, width, percent).select(F.col("doc_id").alias("leak_id")).distinct()
    return docs.join(leaks, docs["doc_id"] == leaks["leak_id"], "left_anti")
