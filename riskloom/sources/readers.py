"""Batch and streaming readers. Schemas are declared, so no pass over the data is spent on inference."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskloom import schemas

DATE_FOLDERS = "year=*/month=*/day=*"


# --- batch -------------------------------------------------------------------------------------------


def parquet_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Files by pattern; the schema comes from the files."""
    return spark.read.parquet(pattern)


def json_lines(
    spark: SparkSession, path: str, schema: StructType = schemas.TRANSACTION, recursive: bool = False
) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", str(recursive).lower()).json(path)


def json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """JSON without a declared schema; reads the data once more to infer it."""
    return spark.read.json(path)


def dated_parquet(
    spark: SparkSession, root: str, file_glob: str = "transactions_*.parquet",
    schema: StructType | None = schemas.TRANSACTION,
) -> DataFrame:
    """Parquet below year=/month=/day= folders; the folder values come back as columns."""
    reader = spark.read.option("basePath", root).option("pathGlobFilter", file_glob)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{root}/{DATE_FOLDERS}")


def dated_json(
    spark: SparkSession, root: str, schema: StructType = schemas.TRANSACTION, file_glob: str = "*"
) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", root).option("pathGlobFilter", file_glob)
    return reader.json(f"{root}/{DATE_FOLDERS}")


def table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with its partition columns."""
    return spark.read.parquet(path)


def all_files(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file below a path. Folder values are not columns then; prefer ``table``."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


@dataclass(frozen=True)
class Source:
    """Where the rows came from."""

    rows: DataFrame
    format: str
    path: str


NOT_FOUND = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def resolve_source(
    spark: SparkSession, flat: str, dated: str, schema: StructType = schemas.TRANSACTION,
    file_glob: str = "transactions_*", json_glob: str = "*.json*",
) -> Source:
    """The first of four layouts that has rows: flat Parquet, flat JSON lines, dated Parquet, dated JSON.

    Only a missing path leads on to the next layout; any other read error is raised.
    """
    dated_path = f"{dated}/{DATE_FOLDERS}"
    layouts = [
        ("parquet", f"{flat}/{file_glob}.parquet",
         lambda: parquet_glob(spark, f"{flat}/{file_glob}.parquet")),
        ("jsonl", flat,
         lambda: spark.read.schema(schema).option("recursiveFileLookup", "true")
         .option("pathGlobFilter", json_glob).json(flat)),
        ("parquet", dated_path, lambda: dated_parquet(spark, dated, f"{file_glob}.parquet", schema)),
        ("jsonl", dated_path, lambda: dated_json(spark, dated, schema, json_glob)),
    ]
    for kind, path, read in layouts:
        try:
            rows = read()
            if not rows.isEmpty():
                return Source(rows, kind, path)
        except AnalysisException as error:
            if error.getCondition() not in NOT_FOUND:
                raise
    raise FileNotFoundError(f"no transactions below {flat} or {dated_path}")


# --- message topics ----------------------------------------------------------------------------------


def topic_batch_options(servers: str, topic: str) -> dict[str, str]:
    """Everything in the topic, from the earliest to the latest message."""
    return {
        "kafka.bootstrap.servers": servers, "subscribe": topic,
        "startingOffsets": "earliest", "endingOffsets": "latest",
    }


def topic_stream_options(
    servers: str, topic: str, starting: str = "latest", per_trigger: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """``per_trigger`` bounds the messages of a micro-batch; by default it takes all there are."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def topic_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return spark.read.format("kafka").options(**topic_batch_options(servers, topic)).load()


def topic_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**topic_stream_options(servers, topic, **options)).load()


# --- file streams ------------------------------------------------------------------------------------


def parquet_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """New files of a folder as they arrive. A file stream needs its schema declared."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files as a ``value`` column, the shape in which messages arrive from a topic."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)
