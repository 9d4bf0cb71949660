"""Batch writers. Counts come from the write itself, not from a second pass over the data."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Setting, and how many files a task holds open at most before it sorts the rest of its rows by partition.
OPEN_FILES = ("spark.sql.maxConcurrentOutputFileWriters", "128")


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Add the write time. Only writers do this, so that results stay comparable."""
    return df.withColumn(name, F.current_timestamp())


@contextmanager
def open_files(spark: SparkSession, **settings: str) -> Iterator[None]:
    """A partitioned write inside keeps one file of each partition open in a task, where Spark would sort all rows of the
    task by partition and spill; the session's setting is put back afterwards, and so are further ``settings``, whose
    names are given with ``__`` for a dot."""
    wanted = dict([OPEN_FILES]) | {name.replace("__", "."): value for name, value in settings.items()}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, rebalance: bool = False,
    stamp_as: str | None = None,
) -> None:
    """Replace a Parquet table, compressed with Zstandard.

    ``rebalance`` shuffles rows by the partition columns before writing, with adaptive execution
    splitting large and joining small partitions. Use it where there are many partition values: without
    it every task would write a file into each of them.
    """
    out = stamp(df, stamp_as) if stamp_as else df
    keys = partition_by or []
    if rebalance:
        out = out.hint("rebalance", *[F.col(k) for k in keys])
    with open_files(df.sparkSession):
        out.write.mode("overwrite").partitionBy(*keys).parquet(path, compression="zstd")


def write_counted(df: DataFrame, path: str, metrics: dict[str, Column] | None = None, **options) -> dict:
    """Write and return metrics observed on the way, by default the number of rows."""
    seen = Observation()
    wanted = metrics or {"rows": F.count(F.lit(1))}
    write_table(df.observe(seen, *[c.alias(name) for name, c in wanted.items()]), path, **options)
    return seen.get


def replace_partitions(
    df: DataFrame, path: str, partition_by: list[str], values: list[tuple], stamp_as: str | None = None
) -> None:
    """Replace some partition folders of a table and leave all others alone.

    ``values`` are the partitions that ``df`` stands for: one that has no row in ``df`` is removed, which dynamic overwrite does
    not do by itself. ``df`` may read the table.
    """
    out = stamp(df, stamp_as) if stamp_as else df
    seen = Observation()
    counted = out.observe(seen, F.collect_set(F.struct(*[F.col(k) for k in partition_by])).alias("found"))
    counted.hint("rebalance", *[F.col(k) for k in partition_by]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    found = {tuple(r) for r in seen.get["found"]}
    spark = df.sparkSession
    for value in values:
        if value not in found:
            names = [f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in zip(partition_by, value, strict=True)]
            place = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *names]))
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def copy_table(
    spark: SparkSession, source: str, target: str, partition_by: list[str] | None = None
) -> int:
    """Copy a table to another place, keeping its partitioning; returns the number of rows."""
    return write_counted(spark.read.parquet(source), target, partition_by=partition_by)["rows"]


def verify_count(spark: SparkSession, path: str, expected: int) -> bool:
    """Read a written table back and compare its row count."""
    return spark.read.parquet(path).count() == expected


# --- databases ---------------------------------------------------------------------------------------

BATCH_SIZE = 10_000
CONNECTIONS = 8


def jdbc_options(
    url: str, table: str, properties: dict[str, str] | None = None, connections: int = CONNECTIONS,
    truncate: bool = True,
) -> dict[str, str]:
    """Options of a parallel, batched load; ``properties`` carry user, password and driver."""
    return {
        "url": url, "dbtable": table, "batchsize": str(BATCH_SIZE), "rewriteBatchedInserts": "true",
        "numPartitions": str(connections), "truncate": str(truncate).lower(), **(properties or {}),
    }


def jdbc_overwrite(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, connections: int = CONNECTIONS
) -> None:
    """Replace the rows of a large table over several connections at once."""
    options = jdbc_options(url, table, properties, connections)
    df.repartition(connections).write.format("jdbc").options(**options).mode("overwrite").save()


def jdbc_overwrite_small(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None
) -> None:
    """Replace a small aggregate table; its rows are not spread first."""
    df.write.format("jdbc").options(**jdbc_options(url, table, properties)).mode("overwrite").save()


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    options = jdbc_options(url, table, properties, truncate=False)
    df.write.format("jdbc").options(**options).mode("append").save()
