"""S1 / S5: scanning and appending entity tables.

A scan is declared with an explicit schema and lets Catalyst push filters and
prune columns into the Parquet reader (or the JDBC query). Nothing is read
until an action runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided Parquet tables, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_entities(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """Scan an entity table with a fixed schema (S1).

    ``fmt="jdbc"`` takes the options from :func:`jdbc_reader_options`; the
    Parquet path is the one exercised by the tests.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        # The database decides the column types; bring them to the declared schema.
        from pyspark.sql import functions as F

        return reader.load().select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return reader.schema(schema).load(path)


def jdbc_reader_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str = "id",
    lower_bound: int = 0,
    upper_bound: int = 1_000_000_000,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for a parallel JDBC scan split on the identity key.

    Each of ``num_partitions`` tasks reads one key range, so a 100 TB table is
    not pulled through a single connection. Bounds only shape the ranges; rows
    outside them are still read by the first and last task.
    """
    opts = {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(num_partitions),
        "fetchsize": str(fetch_size),
        "sessionInitStatement": "SET time_zone = '+00:00'",
    }
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts


def jdbc_writer_options(url: str, table: str, batch_size: int = 1000, **extra) -> dict[str, str]:
    """Options for appending through JDBC in batches of ``batch_size`` rows."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **{k: str(v) for k, v in extra.items()}}


def write_append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Append rows to a table directory (S5 sink)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_bucketed(df: DataFrame, table: str, key: str = "id", buckets: int = 512, mode: str = "overwrite") -> None:
    """Save an entity table bucketed and sorted by its key (catalog table
    under ``spark.sql.warehouse.dir``).

    Lookups against it (Q2's shuffle path) then shuffle only the request side
    into the table's buckets; the entity side is read in place.
    """
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
