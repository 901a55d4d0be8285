from pyspark.sql import functions as F

from ledgerline.operators import keys


def test_dense_ordered_ids_over_many_ranges(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("src"))
    out = keys.assign_ids(df, ["src"], start=100, rows_per_range=300)
    got = sorted((r.src, r.id) for r in out.collect())
    assert [i for _, i in got] == list(range(101, 5101))


def test_next_ids_after_existing(spark):
    existing = spark.createDataFrame([(3,), (42,)], "id long")
    new = spark.createDataFrame([(10,), (5,), (7,)], "src long")
    got = sorted((r.src, r.id) for r in keys.next_ids(new, existing, ["src"]).collect())
    assert got == [(5, 43), (7, 44), (10, 45)]


def test_recompute_is_deterministic(spark):
    df = spark.range(0, 3000).select((F.col("id") * 13 % 3001).alias("src"))
    out = keys.assign_ids(df, ["src"], start=0, rows_per_range=250)
    a = sorted((r.src, r.id) for r in out.collect())
    b = sorted((r.src, r.id) for r in out.collect())
    assert a == b


def test_more_ranges_than_the_grid(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("src"))
    out = keys.assign_ids(df, ["src"], start=0, rows_per_range=3)  # ~1667 ranges > 1024 grid points
    got = sorted((r.src, r.id) for r in out.collect())
    assert [i for _, i in got] == list(range(1, 5001))


def test_null_text_and_hot_leading_keys_keep_every_row(spark):
    rows = [(None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 7}", i % 50) for i in range(600)] + [("hot", 1)] * 30
    df = spark.createDataFrame(rows, "lead string, second int")
    for per_range in (7, 1000):
        got = keys.assign_ids(df, ["lead", "second"], start=5, rows_per_range=per_range).orderBy("id").collect()
        assert [r.id for r in got] == list(range(6, 6 + len(rows)))
        assert [(r.lead or "", r.second) for r in got] == sorted((a or "", b) for a, b in rows)
