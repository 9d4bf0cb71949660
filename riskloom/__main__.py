"""Start a job: ``spark-submit ... riskloom/__main__.py <job> --option value`` or ``python -m riskloom <job>``.

Master, memory, storage and connector jars are left to spark-submit; places are options. Database user,
password and driver come from a properties file, never from the command line.
"""

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskloom import schemas  # noqa: E402
from riskloom.operators import ingest  # noqa: E402
from riskloom.plans import layers  # noqa: E402
from riskloom.session import SETTINGS, tune  # noqa: E402
from riskloom.sources import readers, writers  # noqa: E402
from riskloom.streaming import jobs, sinks  # noqa: E402


def properties(path: str) -> dict[str, str]:
    lines = [line.strip() for line in Path(path).read_text().splitlines()]
    return dict(line.split("=", 1) for line in lines if line and not line.startswith("#"))


def batch(spark, o):
    source = readers.resolve_source(spark, o.flat, o.dated)
    print(layers.run_batch(spark, source.rows, o.root, source.format))


def enriched(spark, o):
    transactions = ingest.from_portuguese(readers.json_lines(spark, o.transactions, _renamed_feed()))
    devices = readers.json_lines(spark, o.devices, schemas.DEVICE)
    customers = ingest.customers_from_portuguese(readers.json_lines(spark, o.customers, schemas.CUSTOMER))
    layers.run_enriched(transactions, devices, customers, o.root, F.lit(o.as_of).cast("date"))


def _renamed_feed():
    names = {english: other for other, english in schemas.PT_TRANSACTION_NAMES.items()}
    feed = type(schemas.TRANSACTION)()
    for field in schemas.TRANSACTION.fields:
        feed = feed.add(names.get(field.name, field.name), field.dataType)
    return feed


def geo(spark, o):
    layers.run_geo(ingest.envelope_from_rows(readers.json_lines(spark, o.input, schemas.GEO)), o.root, o.unit)


def sensitive(spark, o):
    messages = readers.topic_batch(spark, o.servers, o.topic)
    layers.run_sensitive(ingest.parse_json(messages, schema=schemas.GEO), o.root, amount="amount")


def load(spark, o):
    layers.load_reports(spark, o.root, o.url, properties(o.properties), o.connections)


def copy(spark, o):
    print(writers.copy_table(spark, o.source, o.target, o.partition_by))


def _feed(spark, o):
    return readers.topic_stream(spark, o.servers, o.topic, per_trigger=o.per_trigger)


def stream(spark, o):
    jobs.three_hops(spark, _feed(spark, o), o.root, every=o.every)
    sinks.wait_any(spark)


def live(spark, o):
    rows = ingest.parse_json(_feed(spark, o))
    jobs.live_dashboard(rows, _writer(o), f"{o.root}/checkpoints/live", o.every).awaitTermination()


def score(spark, o):
    rows = ingest.parse_json(_feed(spark, o))
    jobs.score_and_fan_out(rows, _writer(o), f"{o.root}/checkpoints/score", o.every).awaitTermination()


def _writer(o):
    if o.url:
        return sinks.jdbc_writer(o.url, properties(o.properties))
    return sinks.batch_folder_writer(f"{o.root}/tables")


OPTIONS = {
    batch: ["flat", "dated", "root"],
    enriched: ["transactions", "devices", "customers", "root", "as-of"],
    geo: ["input", "root", "unit"],
    sensitive: ["servers", "topic", "root"],
    load: ["root", "url", "properties"],
    copy: ["source", "target"],
    stream: ["servers", "topic", "root", "every"],
    live: ["servers", "topic", "root", "every"],
    score: ["servers", "topic", "root", "every"],
}
DEFAULTS = {"unit": "seconds", "every": "10 seconds"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="riskloom", description=__doc__)
    chosen = top.add_subparsers(dest="job", required=True)
    for job, names in OPTIONS.items():
        sub = chosen.add_parser(job.__name__)
        sub.set_defaults(run=job)
        for name in names:
            sub.add_argument(f"--{name}", default=DEFAULTS.get(name), required=name not in DEFAULTS)
        if job is copy:
            sub.add_argument("--partition-by", nargs="*")
        if job in (stream, live, score):
            sub.add_argument("--per-trigger", type=int)
        if job is load:
            sub.add_argument("--connections", type=int)
        if job in (live, score):
            sub.add_argument("--url")
            sub.add_argument("--properties")
    return top


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    builder = SparkSession.builder.appName(f"riskloom {options.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    options.run(tune(builder.getOrCreate()), options)


if __name__ == "__main__":
    main()
