"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Noting the call site of every column expression takes milliseconds each, most
    # of the time it takes to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# For loads: larger pieces of a rebalanced table, hence fewer and larger files.
LOAD_SETTINGS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m"}


# For inputs of this size and more, scan tasks take larger pieces.
_LARGE_INPUT = 10 * 1024**4


def sized(
    input_bytes: int, bytes_each: int = 512 << 20, max_partitions: int = 200_000,
    large_input: int = _LARGE_INPUT,
) -> dict[str, str]:
    """Settings that follow the size of the input.

    Adaptive execution merges shuffle partitions that are small, but does not cut
    ones that are all too large: their number at the start has to fit the data. One
    per ``bytes_each`` of input leaves pieces an executor holds, as a shuffle is
    narrower than the input; ``max_partitions`` keeps the count of blocks in hand.
    """
    partitions = min(max(200, -(-input_bytes // bytes_each)), max_partitions)
    settings = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)}
    if input_bytes >= large_input:
        settings["spark.sql.files.maxPartitionBytes"] = "512m"
    return settings


def configure(
    builder: SparkSession.Builder, load: bool = False, input_bytes: int | None = None
) -> SparkSession.Builder:
    """Put the settings on a session builder; ``input_bytes`` is the size of the tables."""
    settings = SETTINGS | (LOAD_SETTINGS if load else {})
    if input_bytes is not None:
        settings |= sized(input_bytes)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, in the shared folder of the cluster.

    It is removed when the driver ends, as the tables read from it may be used until
    then. A machine-local folder serves only for a local master without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    folder = f"{shared.rstrip('/')}/cardlake-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)  # only what is there can be marked
    files.deleteOnExit(path)
    return folder
