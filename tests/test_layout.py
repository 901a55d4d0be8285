from ledgerline.plans.layout import spread
from ledgerline.session import checkpoint_dir, scratch_path


def test_spread_only_when_splits_are_few(spark):
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one, 8).rdd.getNumPartitions() == 8
    many = spark.range(0, 1000, numPartitions=16)
    assert spread(many, 8) is many  # already wide enough: plan unchanged


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = checkpoint_dir(spark)
    assert base == spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "snap"), scratch_path(spark, "snap")
    assert a != b and a.startswith(base.rstrip("/") + "/ledgerline/snap-")
