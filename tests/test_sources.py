import datetime as dt

from ledgerline import schemas
from ledgerline.sources import tables


def test_scan_entities_uses_the_declared_schema(spark, tmpdir_fresh):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, "a", "x", t, t, None), (2, "b", "y", t, t, t)]
    path = tmpdir_fresh + "/entities"
    tables.write_append(spark.createDataFrame(rows, schemas.ENTITY), path)
    tables.write_append(spark.createDataFrame(rows[:1], schemas.ENTITY), path)
    df = tables.scan_entities(spark, path, schemas.ENTITY)
    assert [f.name for f in df.schema.fields] == [f.name for f in schemas.ENTITY.fields]
    assert df.count() == 3


def test_jdbc_options_split_on_the_key():
    o = tables.jdbc_reader_options("jdbc:mysql://db/app", "example", user="u", password="p", num_partitions=128,
                                   lower_bound=1, upper_bound=10_000_000)
    assert (o["partitionColumn"], o["numPartitions"], o["lowerBound"], o["upperBound"]) == ("id", "128", "1", "10000000")
    assert o["dbtable"] == "example" and o["user"] == "u"
    assert tables.jdbc_writer_options("jdbc:mysql://db/app", "example")["batchsize"] == "1000"


def test_read_table_reads_the_provided_parquet(spark):
    assert tables.read_table(spark, "/root/testdata/sf0.001/", "region").count() == 5
