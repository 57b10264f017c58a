"""Tables that change by one small file, so that readers see a load whole or not at all.

The rows of each load lie in a folder of their own, ``name/load_number=N``, below it in
partition folders if there are any. A version names the folders that make up the table. It
is written once these are complete, and readers follow the newest one. A load that fails
on the way leaves a folder that no version names. A load can bring the whole table, add
rows, or replace some partition folders, in which case all others stay as they are.

One publisher at a time may write a table; a second one is noticed and refused.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardlake.sources.readers import read_table
from cardlake.sources.writers import write_table

LOAD = "load_number"
_POINTERS = "_versions"  # hidden from readers of the folder by its name
# Tasks, at most, that list the folders of a version.
LISTING_TASKS = 200
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _place(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def _leaves(spark: SparkSession, path: str, levels: int) -> list[str]:
    """Partition folders below ``path``, or ``path`` itself, relative to it."""
    if not levels:
        return [""]
    below = [n for n in _names(spark, path) if "=" in n]
    return [f"/{n}{rest}" for n in below for rest in _leaves(spark, f"{path}/{n}", levels - 1)]


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the published versions that are kept, oldest first."""
    found = _names(spark, f"{root}/{name}/{_POINTERS}")
    return [int(n.removesuffix(".json")) for n in found if n.endswith(".json")]


def folders(spark: SparkSession, root: str, name: str, version: int | None = None) -> list[str] | None:
    """Folders that make up a version, by default the newest; None if there is none."""
    known = versions(spark, root, name)
    if not known:
        return None
    number = known[-1] if version is None else version
    files, place = _place(spark, f"{root}/{name}/{_POINTERS}/{number:012d}.json")
    stream = files.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()))["folders"]
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, name: str, version: int, parts: list[str]) -> None:
    path = f"{root}/{name}/{_POINTERS}/{version:012d}.json"
    files, place = _place(spark, path)
    _, aside = _place(spark, f"{root}/{name}/{_POINTERS}/.{version:012d}")
    stream = files.create(aside, True)
    stream.write(bytearray(json.dumps({"version": version, "folders": parts}).encode()))
    stream.close()
    if files.exists(place) or not files.rename(aside, place):
        raise RuntimeError(f"another load published version {version} of {name}")


def publish(
    df: DataFrame, root: str, name: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
    **layout,
) -> int:
    """Write ``df``, then make it (part of) the table; return the number of the version.

    ``overwrite`` replaces the table, ``append`` adds to it, and ``replace_partitions``
    replaces the partition folders that occur in ``df``, or the table where it has
    none. Up to the end readers have the version before, also as the source of ``df``.
    ``layout`` goes to :func:`cardlake.sources.writers.write_table`.
    """
    spark = df.sparkSession
    if mode not in ("overwrite", "append", "replace_partitions"):
        raise ValueError(f"no such mode: {mode}")
    known = versions(spark, root, name)
    version = known[-1] + 1 if known else 1
    load = f"{LOAD}={version}"
    # Left by a load that failed: overwritten.
    write_table(df, f"{root}/{name}/{load}", partition_by, mode="overwrite", **layout)
    new = _leaves(spark, f"{root}/{name}/{load}", len(partition_by))
    kept = []
    if known and mode != "overwrite":
        kept = folders(spark, root, name)
        if mode == "replace_partitions":
            kept = [f for f in kept if partition_by and f[f.find("/"):] not in new]
    _commit(spark, root, name, version, kept + [load + part for part in new])
    return version


def read(
    spark: SparkSession, root: str, name: str, schema: str | StructType | None = None,
    version: int | None = None, only: Collection[str] | None = None,
) -> DataFrame:
    """The table as of a version, by default the newest.

    A table that was written without versions is read as it lies there; one with a
    version but no rows needs a schema. Of a table with versions, ``only`` names the
    partition folders (``column=value``) that are read; others are not even listed.
    """
    parts = folders(spark, root, name, version)
    if parts is None:
        return read_table(spark, f"{root}/{name}", schema)
    if only is not None:
        parts = [part for part in parts if part.partition("/")[2] in only]
    if not parts:
        if schema is None:
            raise ValueError(f"{name} has no rows: a schema is needed")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema else spark.read
    table = reader.option("basePath", f"{root}/{name}")
    # Folders are listed by tasks: by one for each folder, most of the time is Spark's own.
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), LISTING_TASKS)))
    try:
        return table.parquet(*[f"{root}/{name}/{part}" for part in parts]).drop(LOAD)
    finally:
        spark.conf.set(_LISTING, before)


def vacuum(spark: SparkSession, root: str, name: str, keep: int = 2) -> int:
    """Delete what only versions before the newest ``keep`` use; how many folders went.

    Readers that began with an older version lose its files. The folder of a load that
    failed goes with the next version but one.
    """
    known = versions(spark, root, name)
    old, current = known[:-keep], known[-keep:]
    used = {part for v in current for part in folders(spark, root, name, v)}
    gone = 0
    for v in old:
        files, place = _place(spark, f"{root}/{name}/{_POINTERS}/{v:012d}.json")
        files.delete(place, False)
    for load in _names(spark, f"{root}/{name}"):
        if not load.startswith(f"{LOAD}=") or not current or int(load.split("=")[1]) > current[-1]:
            continue
        levels = max((part.count("/") for part in used if part.split("/")[0] == load), default=0)
        for part in _leaves(spark, f"{root}/{name}/{load}", levels):
            if load + part not in used:
                files, place = _place(spark, f"{root}/{name}/{load}{part}")
                files.delete(place, True)
                gone += 1
    return gone
