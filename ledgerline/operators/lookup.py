"""Q1, Q2, Q3: key lookup, lookup with a typed miss, projection.

Set-at-a-time: a batch of requests is answered by one join against the
entity table instead of one point query per key.

Join strategy:
* ``auto``: the entity table is first reduced to the requested keys by a
  left-semi join, then joined to the requests. Both joins carry no hint: Spark
  broadcasts the keys (then the entity table is filtered while it is scanned,
  never shuffled) and the hits where their sizes are under its threshold, and
  shuffles on the key otherwise; the second join reuses the first one's layout.
* ``shuffle``: both sides are shuffled on the key (sort-merge join). AQE's skew
  join splits a request key that holds a large share of the batch; the entity
  side has one row per key so nothing on it can be hot. An entity table saved
  with ``sources.tables.save_bucketed`` is not shuffled at all.
* ``split_hot``: keys that hold more than ``HOT_SHARE`` of the requests are found by
  a frequent-items sketch (it misses none and names at most 1 / ``HOT_SHARE``).
  Their requests are not shuffled: they stay in the tasks that read them and meet
  the few hot entities by broadcast. All others are joined as in ``shuffle``, so a
  bucketed entity table still stays in place and no bucket has a hot key.
* ``broadcast_requests``: the keys are broadcast, after their number was
  counted and found within ``max_broadcast_rows``.

Requests without a key match nothing; they are dealt over all partitions of
the join by a hash of their columns instead of meeting in the null key's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.envelope import envelope
from ledgerline.operators.errors import status_of

PROJECTION = ("id", "name", "description")
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
HOT_SHARE = 0.01


def project(entities: DataFrame) -> DataFrame:
    """Q3: keep id, name, description; audit columns are pruned from the scan."""
    return entities.select(*PROJECTION)


def find(entities: DataFrame, key: int) -> DataFrame:
    """Q1 for one key. The predicate is pushed into the Parquet / JDBC scan.

    There is no ``deleted_at`` filter: soft-deleted rows are returned.
    """
    return entities.where(F.col("id") == F.lit(key))


def find_many(entities: DataFrame, keys: DataFrame, key: str = "id",
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Q1 for a batch: every entity whose id is among ``keys`` (hits only).
    With ``max_broadcast_rows=0`` the keys are never broadcast."""
    k = keys.select(F.col(key).alias("id")).where(F.col("id").isNotNull())
    return entities.join(k if max_broadcast_rows else k.hint("merge"), "id", "left_semi")


STRATEGIES = ("auto", "broadcast_requests", "shuffle", "split_hot")


def hot_keys(requests: DataFrame, key: str = "id", share: float = HOT_SHARE) -> list:
    """Every key with more than ``share`` of the requests that have one, and
    maybe others; at most 1 / ``share`` of them."""
    keys = requests.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull())
    return list(keys.freqItems(["_k"], share).first()[0] or [])


def lookup(requests: DataFrame, entities: DataFrame, key: str = "id",
           max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, strategy: str = "auto") -> DataFrame:
    """Q2: one output row per request (duplicates kept) with the entity's
    projected columns as ``entity`` (null on a miss) and ``found``.

    ``strategy``: see above; ``auto`` with ``max_broadcast_rows=0`` is ``shuffle``.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    ents = entities.select(F.col("id").alias("_eid"), F.struct(*PROJECTION).alias("entity"))
    if strategy == "broadcast_requests" or (strategy == "auto" and max_broadcast_rows):
        keys = requests.select(F.col(key).alias("_eid")).where(F.col("_eid").isNotNull())
        if strategy == "broadcast_requests":
            n = keys.count()
            if n > max_broadcast_rows:
                raise ValueError(f"{n} requests are more than max_broadcast_rows={max_broadcast_rows}")
            keys = F.broadcast(keys)
        ents = ents.join(keys, "_eid", "left_semi")
    hashable = [F.col(c) for c, t in requests.dtypes if not ("map<" in t or "variant" in t)]
    if strategy == "split_hot" and (hot := hot_keys(requests, key)):
        is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
        few = F.broadcast(ents.where(F.col("_eid").isin(hot)))  # one entity a key: at most 1 / HOT_SHARE rows
        met = requests.where(is_hot).join(few, F.col(key) == F.col("_eid"), "left")
        met = met.withColumn("found", F.col("_eid").isNotNull()).drop("_eid")
        return met.unionByName(lookup(requests.where(~is_hot), entities, key, max_broadcast_rows, "shuffle"))
    spread_key = F.coalesce(F.col(key), F.xxhash64(*hashable) if hashable else F.lit(0))
    out = requests.join(ents, (spread_key == F.col("_eid")) & F.col(key).isNotNull(), "left")
    return out.withColumn("found", F.col("_eid").isNotNull()).drop("_eid")


def not_found_message(key: Column) -> Column:
    """Message of a miss, naming the id."""
    return F.format_string("No item was found for id %d.", key)


def answer(requests: DataFrame, entities: DataFrame, key: str = "id",
           max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, strategy: str = "auto") -> DataFrame:
    """Q2 -> Q3 -> Q4/Q5: each request with its ``response`` envelope and
    ``status`` (200 on success, else the error type's status).

    Requests that already carry an ``error_type`` (rejected by V2/V3) keep it
    and are not looked up; others become NOT_FOUND on a miss.
    """
    if "error_type" not in requests.columns:
        requests = requests.withColumns({"error_type": F.lit(None).cast("string"),
                                         "custom_message": F.lit(None).cast("string")})
    rejected = F.col("error_type").isNotNull()
    looked = lookup(requests, entities, key, max_broadcast_rows, strategy)
    miss = ~F.col("found") & ~rejected
    err_type = F.when(rejected, F.col("error_type")).when(miss, F.lit("NOT_FOUND"))
    custom = F.when(rejected, F.col("custom_message")).when(miss, not_found_message(F.col(key)))
    ok = F.col("found") & ~rejected
    return looked.withColumns({
        "response": envelope(ok, F.col("entity"), err_type, custom),
        "status": F.when(ok, F.lit(200)).otherwise(status_of(err_type)),
    }).drop("entity", "found", "error_type", "custom_message")
