"""What several operators of this package share."""

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import work_folder

#: Rows up to which a one- or two-column table is broadcast (about 100 MB as a hash table).
BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{work_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives Spark the true size for choosing a join.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, else as it is (Spark then shuffles)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def whole_text(name: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(name), F.lit(""))


def text_bytes(name: str = "text") -> Column:
    return F.encode(whole_text(name), "UTF-8")


def give_back() -> None:
    """Return to the system what earlier tasks of this Python worker have freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
