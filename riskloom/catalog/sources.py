"""Sources and layouts (S, P5): the feed is written below the shared folder in each layout and read back."""

import threading
import uuid

from pyspark.sql import functions as F

from riskloom.catalog.base import check, feed, input_version, query, raw_customers
from riskloom.catalog.cleaning import FEED, FEED_SQL
from riskloom.operators import ingest
from riskloom.session import work_folder
from riskloom.plans import quality
from riskloom.sources import readers, writers

_roots: dict[tuple, str] = {}
_lock = threading.Lock()
MONTHS = ["year", "month", "day"]


#: Bytes of narrow rows for a task that writes them as transactions, some ten times wider.
MONTH_BYTES = "4m"


def _feed(spark, sf, by=None):
    return feed(spark, sf, by).select(*FEED)


def _monthly(spark, sf, write):
    """Write the feed by month. A month's rows are brought together before they are made wide, so that a folder has few
    files however many tasks the feed is made in, and no second shuffle holds whole transactions."""
    rows = ingest.with_date_columns(_feed(spark, sf, "date_trunc('MONTH', o_orderdate)")).withColumn("day", F.lit("01"))
    with writers.open_files(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=MONTH_BYTES):
        write(rows.write.partitionBy(*MONTHS))


#: JSON lines are compressed: as text they are many times the size of the tables.
LAYOUTS = {
    "flat": lambda s, sf, path: _feed(s, sf).write.parquet(path, compression="zstd"),
    "lines": lambda s, sf, path: _feed(s, sf).write.json(f"{path}/a/b", compression="gzip"),
    "dated": lambda s, sf, path: _monthly(s, sf, lambda w: w.parquet(path, compression="zstd")),
    "dated-lines": lambda s, sf, path: _monthly(s, sf, lambda w: w.json(path, compression="gzip")),
    "customers": lambda s, sf, path: raw_customers(s, sf).write.json(path, compression="gzip"),
}


def _layout(spark, sf, name: str) -> str:
    """Root of a layout, which is written below ``<root>/<name>`` when a query of an application first reads it."""
    key = (name, *input_version(spark, sf))
    with _lock:
        if key not in _roots:
            root = f"{work_folder(spark)}/riskloom-layouts-{uuid.uuid4().hex}"
            LAYOUTS[name](spark, sf, f"{root}/{name}")
            _roots[key] = root
        return _roots[key]


def _read(name, build):
    return query(lambda spark, sf: build(spark, _layout(spark, sf, name)).select(*FEED))


def _resolved(spark, sf):
    """Only the last of the four layouts exists."""
    root = _layout(spark, sf, "dated-lines")
    found = readers.resolve_source(spark, f"{root}/none/transactions_*", f"{root}/dated-lines", json_glob="*.json*")
    return found.rows.select(*FEED).withColumn("format", F.lit(found.format))


def _inferred(spark, sf):
    rows = readers.json_inferred(spark, f"{_layout(spark, sf, 'lines')}/lines/a/b")
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("rows"), F.count("amount").alias("amounts"))


def _customers(spark, sf):
    rows = readers.json_lines(spark, f"{_layout(spark, sf, 'customers')}/customers", raw_customers(spark, sf).schema)
    return rows.select("customer_id", "email", "credit_score")


def _copied(spark, sf):
    root = _layout(spark, sf, "flat")
    target = f"{root}/copies/{uuid.uuid4().hex}"
    counted = writers.copy_table(spark, f"{root}/flat", target, None)
    return spark.read.parquet(target).agg(F.count(F.lit(1)).alias("rows")).withColumn("counted", F.lit(counted).cast("long"))


def _copy_compared(spark, sf):
    """A copy that is partitioned, and so spread and ordered, in another way, compared by its content."""
    root = _layout(spark, sf, "flat")
    target = f"{root}/copies/{uuid.uuid4().hex}"
    writers.copy_table(spark, f"{root}/flat", target, ["type"])
    return quality.compare_tables(spark.read.parquet(f"{root}/flat"), spark.read.parquet(target), {"*": FEED, "money": ["transaction_id", "amount"]})


def _keys(spark, sf):
    """Every fifth key is lost on the way; rows without one go."""
    rows = feed(spark, sf).select("transaction_id", "customer_id")
    holed = rows.withColumn("transaction_id", F.when(F.substring("customer_id", -1, 1) != "5", F.col("transaction_id")))
    return ingest.with_key(holed)


QUERIES = {
    "s01_parquet_glob": _read("flat", lambda s, root: readers.parquet_glob(s, f"{root}/flat/part-*")),
    "s02_json_lines": _read("lines", lambda s, root: readers.json_lines(s, f"{root}/lines", recursive=True)),
    "s03_dated_parquet": _read("dated", lambda s, root: readers.dated_parquet(s, f"{root}/dated", "*.parquet", None)),
    "s04_dated_json": _read("dated-lines", lambda s, root: readers.dated_json(s, f"{root}/dated-lines")),
    "s05_resolved": query(_resolved),
    "s06_json_inferred": query(_inferred),
    "s07_json_dimension": query(_customers),
    "s09_all_files": _read("dated", lambda s, root: readers.all_files(s, f"{root}/dated")),
    "s21_s22_copy": query(_copied),
    "s21_s22_copy_content": query(_copy_compared),
    "p05_with_key": query(_keys),
}

_ALL = check("fx_tx", f"SELECT {FEED_SQL} FROM fx_tx")

ORACLE = {
    "s01_parquet_glob": _ALL,
    "s02_json_lines": _ALL,
    "s03_dated_parquet": _ALL,
    "s04_dated_json": _ALL,
    "s05_resolved": check("fx_tx", f"SELECT {FEED_SQL}, 'jsonl' AS format FROM fx_tx"),
    "s06_json_inferred": check("fx_tx", "SELECT type, count(*) AS rows, count(amount) AS amounts FROM fx_tx GROUP BY type"),
    "s07_json_dimension": check("customers", "SELECT customer_id, email, credit_score FROM fx_customers"),
    "s09_all_files": _ALL,
    "s21_s22_copy_content": check("fx_tx", """SELECT c AS columns, n AS rows_left, n AS rows_right, true AS same
        FROM (SELECT count(*) AS n FROM fx_tx), (VALUES ('*'), ('money')) v(c)"""),
    "s21_s22_copy": check("fx_tx", "SELECT count(*) AS rows, count(*) AS counted FROM fx_tx"),
    "p05_with_key": check("fx_tx", "SELECT transaction_id, customer_id FROM fx_tx WHERE right(customer_id, 1) <> '5'"),
}
