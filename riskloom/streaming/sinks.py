"""Starting stream writers.

Every job has its own checkpoint folder, which together with idempotent writes gives each result once:
appended files are tracked by the file sink, and tables written from a micro-batch go to a folder named
by the batch number, which a repeated batch overwrites.
"""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskloom.sources import writers

BatchWriter = Callable[[DataFrame, str, int], None]


def trigger(every: str | None) -> dict:
    """A processing-time trigger, or, with None, everything available now and then stop."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def append_table(df: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    return (
        df.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    )


def replace_table(df: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    """Running aggregate: after each micro-batch the whole result becomes the table's next version. File sinks do
    not take complete results themselves. ``read_newest`` reads the newest complete version, also while the next one
    is written or after it has failed; the version before it is kept for readers that have begun."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        _remove(batch.sparkSession, path, "version", batch_id - 1)

    return _for_each(df, write, checkpoint, every, "complete")


def each_batch(
    df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "10 seconds",
    level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER,
) -> StreamingQuery:
    """Run ``work`` on the rows of every micro-batch, kept while it runs so that several writes read them
    once. Empty batches are skipped. ``level`` says where they are kept: on disk alone for rows that would fill the memory."""

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist(level)
        try:
            if not rows.isEmpty():
                work(rows, batch_id)
        finally:
            rows.unpersist()

    return _for_each(df, step, checkpoint, every, "append")


def _for_each(df: DataFrame, step, checkpoint: str, every: str | None, mode: str) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(step).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    )


def batch_folder_writer(root: str) -> BatchWriter:
    """Write a micro-batch's rows of a table to ``<root>/<table>/batch_id=<n>``."""

    def write(rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")

    return write


def jdbc_writer(url: str, properties: dict[str, str]) -> BatchWriter:
    """Append to database tables. A repeated micro-batch appends again, so the table needs a key or a
    later clean-up where that matters."""

    def write(rows: DataFrame, name: str, batch_id: int) -> None:
        writers.jdbc_append(rows, url, name, properties)

    return write


def read_batches(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows of a table written batch by batch, compacted or not."""
    merged = numbered(spark, f"{root}/{name}-merged", "version")
    upto = max(merged, default=-1)
    paths = [f"{root}/{name}/batch_id={n}" for n in numbered(spark, f"{root}/{name}", "batch_id") if n > upto]
    paths += [f"{root}/{name}-merged/version={upto}"] if merged else []
    return spark.read.parquet(*paths)


def compact(spark: SparkSession, root: str, name: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merge all batches of a table but the newest, which may still be repeated, into one folder.

    The merged folder names the last batch in it; readers leave out batches up to that one, so they may go afterwards
    and a compaction that fails halfway changes nothing.
    """
    closed = numbered(spark, f"{root}/{name}", "batch_id")[:-1]
    upto = max(numbered(spark, f"{root}/{name}-merged", "version"), default=-1)
    paths = [f"{root}/{name}/batch_id={n}" for n in closed if n > upto]
    if not paths:
        return
    paths += [f"{root}/{name}-merged/version={upto}"] if upto >= 0 else []
    merge(spark.read.parquet(*paths)).write.mode("overwrite").parquet(f"{root}/{name}-merged/version={closed[-1]}")
    _remove(spark, f"{root}/{name}", "batch_id", closed[-1] + 1)
    _remove(spark, f"{root}/{name}-merged", "version", closed[-1])


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a table that is replaced as a whole."""
    versions = numbered(spark, path, "version")
    if not versions:
        raise FileNotFoundError(f"no complete version below {path}")
    return spark.read.parquet(f"{path}/version={versions[-1]}")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def numbered(spark: SparkSession, path: str, label: str) -> list[int]:
    """Numbers of the complete folders ``<label>=<n>`` below a path, in order."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place) if status.isDirectory()]
    found = [int(n.split("=")[1]) for n in names if n.startswith(f"{label}=")]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(n for n in found if system.exists(marker(f"{path}/{label}={n}/_SUCCESS")))


def _remove(spark: SparkSession, path: str, label: str, before: int) -> None:
    """Delete complete folders with a number below ``before``."""
    for n in numbered(spark, path, label):
        if n < before:
            system, place = _file_system(spark, f"{path}/{label}={n}")
            system.delete(place, True)


def wait_first_rows(query: StreamingQuery, pause: int = 1) -> None:
    """Block until a job has written its first rows, so that the next one finds a folder to read. A job that fails
    before that raises here."""
    while query.isActive and not any(p.numInputRows for p in query.recentProgress):
        query.awaitTermination(pause)
    failure = query.exception()
    if failure is not None:
        raise failure


def wait_any(spark: SparkSession, seconds: int | None = None) -> None:
    """Block until one of the running jobs stops or fails."""
    spark.streams.awaitAnyTermination(seconds) if seconds else spark.streams.awaitAnyTermination()
