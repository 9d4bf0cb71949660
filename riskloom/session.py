"""Session settings and the shared work folder."""

import re
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# The JVM compiles no method above 8000 bytes of bytecode but interprets it. Whole-stage code for wide
# projections exceeds that easily; under this limit Spark generates smaller methods for them instead.
CODEGEN_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def tune(spark: SparkSession) -> SparkSession:
    """Apply the method size limit unless the session has a setting of its own."""
    name, limit = CODEGEN_LIMIT
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, limit)
    return spark


def local_session(cores: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and timing; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("riskloom")
    options = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(cores),
        **extra,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


_own_folders: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The folder shared by driver and executors, named by ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) is a fresh local folder made; a cluster
    without the setting is an error, because its executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _own_folders[application]
