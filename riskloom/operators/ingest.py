"""From raw rows or messages to Bronze."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from riskloom import schemas
from riskloom.functions import ladders
from riskloom.functions.measures import finite


def parse_json(df: DataFrame, column: str = "value", schema: StructType = schemas.TRANSACTION) -> DataFrame:
    """JSON text or message bytes to typed columns; messages without a transaction key are dropped.

    A malformed message parses to nulls and is dropped with them; a field of the wrong type, and a number that is NaN
    or infinite, is null.
    """
    parsed = df.select(F.from_json(F.col(column).cast("string"), schema).alias("data")).select("data.*")
    numbers = {f.name: finite(f.name) for f in schema.fields if f.dataType.simpleString() == "double"}
    return with_key(parsed.withColumns(numbers) if numbers else parsed)


#: Why a message is not kept, in the order in which it is looked at.
EMPTY, MALFORMED, NO_KEY, WRONG_TYPE = "EMPTY", "MALFORMED", "NO_KEY", "WRONG_TYPE"


def examined(
    df: DataFrame, column: str = "value", schema: StructType = schemas.TRANSACTION, key: str = "transaction_id", strict: bool = True
) -> DataFrame:
    """``df`` with ``data`` (the typed fields of a JSON message), ``reason`` (null for a message that is kept), ``fields``
    (names of fields of the wrong type) and ``raw`` (the text). Nothing is dropped.

    A message is EMPTY without text, MALFORMED if it is no JSON object, without a key if ``key`` is missing or null, and
    of a WRONG_TYPE if a field's value does not fit the schema. Without ``strict`` the last kind is kept, its unfit fields null.
    """
    raw = F.col(column).cast("string")
    corrupt = StructType([*schema.fields]).add("_corrupt", "string")
    read = df.withColumns({
        "raw": raw,
        "_read": F.from_json(raw, corrupt, {"columnNameOfCorruptRecord": "_corrupt"}),
        "_texts": F.from_json(raw, "map<string,string>"),
    })
    numbers = {f.name for f in schema.fields if f.dataType.simpleString() == "double"}
    data = F.struct(*[(finite(F.col("_read")[f.name]) if f.name in numbers else F.col("_read")[f.name]).alias(f.name) for f in schema.fields])
    unfit = F.filter(
        F.array(*[F.when(F.col("_texts")[f.name].isNotNull() & F.col("_read")[f.name].isNull(), F.lit(f.name)) for f in schema.fields]),
        lambda name: name.isNotNull())
    wrong = (F.size("fields") > 0) | (F.col("_read")["_corrupt"].isNotNull())
    reason = (
        F.when(F.col("raw").isNull() | (F.trim("raw") == ""), EMPTY)
        .when(F.col("_texts").isNull(), MALFORMED)
        .when(F.col("_texts")[key].isNull(), NO_KEY))
    if strict:
        reason = reason.when(wrong, WRONG_TYPE)
    else:  # a key of the wrong type is no key
        reason = reason.when(F.col("_read")[key].isNull(), NO_KEY)
    return read.withColumns({"data": data, "fields": unfit}).withColumn("reason", reason).drop("_read", "_texts")


def kept(seen: DataFrame) -> DataFrame:
    """The typed rows of messages that ``examined`` keeps."""
    return seen.where(F.col("reason").isNull()).select("data.*")


def rejected(seen: DataFrame, *more: str) -> DataFrame:
    """(reason, fields, raw, ``more``): the other messages, as they came."""
    return seen.where(F.col("reason").isNotNull()).select("reason", "fields", "raw", *more)


def with_key(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows that have a key; a table without the column is passed through."""
    return df.where(F.col(key).isNotNull()) if key in df.columns else df


def to_json_text(df: DataFrame, name: str = "raw_json") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(name))


def envelope_from_topic(df: DataFrame) -> DataFrame:
    """Raw messages with their coordinates."""
    return df.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        "topic",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def envelope_from_rows(df: DataFrame, topic: str = "transactions") -> DataFrame:
    """The same envelope around rows read from files. The offset is only an identifier: it grows within
    a task but has gaps, unlike a real offset."""
    now = F.current_timestamp()
    return to_json_text(df).select(
        F.lit(None).cast("string").alias("kafka_key"), "raw_json", F.lit(topic).alias("topic"),
        F.lit(0).alias("kafka_partition"), F.monotonically_increasing_id().alias("kafka_offset"),
        now.alias("kafka_timestamp"), now.alias("ingestion_timestamp"),
    )


def with_metadata(df: DataFrame, layer: str, source_format: str, now: Column | None = None) -> DataFrame:
    """Ingestion time, source layer and format, processing date; ``now`` fixes the time."""
    at = F.current_timestamp() if now is None else now
    return df.withColumns({
        "ingestion_timestamp": at, "source_layer": F.lit(layer), "source_format": F.lit(source_format),
        "processing_date": at.cast("date"),
    })


def with_source_file(df: DataFrame, name: str = "_source_file") -> DataFrame:
    """Path of the file each row was read from; call it directly on a file scan."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def with_date_columns(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """year, month and day of the event time, if the time column exists; null for malformed times."""
    if time not in df.columns:
        return df
    at = F.try_to_timestamp(F.col(time).cast("string"))
    return df.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)})


def bronze(df: DataFrame, source_format: str, layer: str = "raw", now: Column | None = None) -> DataFrame:
    """Keyed rows at their contract types, with metadata and date columns."""
    return with_date_columns(with_metadata(schemas.conform(with_key(df)), layer, source_format, now))


def from_portuguese(df: DataFrame) -> DataFrame:
    """The Portuguese feed under the names and status values used here."""
    status = ladders.relabel(F.col("status"), schemas.PT_STATUS)
    return df.withColumnsRenamed(schemas.PT_TRANSACTION_NAMES).withColumn("status", status)


def customers_from_portuguese(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(schemas.PT_CUSTOMER_NAMES)


def read_nanosecond_parquet(spark: SparkSession, path: str, time_columns: list[str]) -> DataFrame:
    """Parquet whose timestamps are in nanoseconds, brought to microseconds while reading.

    Spark can read such columns only as whole numbers, under a session setting that is put back
    afterwards; the conversion itself is an ordinary projection over all files in parallel.
    """
    setting = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        raw = spark.read.parquet(path)
    finally:
        spark.conf.set(setting, before)
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    return raw.withColumns({
        c: F.timestamp_micros(F.expr(f"`{c}` div 1000")) if isinstance(kinds[c], LongType) else F.col(c)
        for c in time_columns
    })
