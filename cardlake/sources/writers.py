"""Writers: partitioned tables, catalog tables, JDBC, versioned tables."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

_VERSIONS = "version BIGINT, path STRING, committed_at TIMESTAMP"
# Pieces that the shuffles of a table to be written begin with, at least, bytes of files
# that a task of it reads, at most, and bytes to which adaptive execution merges pieces where
# the session does not say: these are compressed, what is sorted or summed up is not.
PIECES, READ_BYTES, MERGED_BYTES = 600, 32 << 20, 16 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_READ = "spark.sql.files.maxPartitionBytes"
_MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def small_pieces(spark: SparkSession) -> Iterator[None]:
    """What is written inside is sorted and summed up in pieces a task can hold.

    A session may have few shuffle partitions; a piece of such a shuffle would grow with the
    table, and adaptive execution merges pieces but does not cut ranges or groups. So
    shuffles begin with more pieces, and scans whose rows are summed up are cut finer.
    A session's own settings hold where they go further.
    """
    before = {_INITIAL: spark.conf.get(_INITIAL, None), _READ: spark.conf.get(_READ),
              _MERGED: spark.conf.get(_MERGED, None)}
    shuffled = int(before[_INITIAL] or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(_INITIAL, str(max(shuffled, PIECES)))
    spark.conf.set(_READ, f"{min(_bytes(before[_READ]), READ_BYTES)}b")
    if before[_MERGED] is None:
        spark.conf.set(_MERGED, f"{MERGED_BYTES}b")
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _laid_out(
    df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str], mode: str,
    cluster_by: Sequence[str] = (), bloom: Mapping[str, int] | None = None,
) -> DataFrameWriter:
    if cluster_by:
        # Ranges: a key lies in one file, or in a few where the columns after it cut a
        # hot one, and readers skip the other files by min/max. The bounds come from a
        # sample, for which the source is read once more.
        df = df.repartitionByRange(*[F.col(c) for c in (*partition_by, *cluster_by)])
    elif partition_by:
        # One shuffle brings the rows of a folder together, so that files are few.
        # Adaptive execution cuts a folder that is too large for one task.
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if partition_by or sort_by:
        # The partitioned writer sorts by folder anyway; sorting on lets readers
        # skip row groups and pages by min/max of the look-up keys.
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.format("parquet")
    for column, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True).option(
            f"parquet.bloom.filter.expected.ndv#{column}", values)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "replace_partitions":
        return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return writer.mode(mode).option("partitionOverwriteMode", "static")


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
    mode: str = "overwrite", cluster_by: Sequence[str] = (),
    bloom: Mapping[str, int] | None = None,
) -> None:
    """Write a Parquet table; with ``cluster_by`` in files that hold ranges of these columns.

    ``bloom`` names columns that the files are not clustered by but are looked up, with
    the different values a row group may have: each row group then has a Bloom filter of
    some ten bits a value, and a reader passes over those that do not hold the value asked.
    ``overwrite`` and ``replace_partitions`` (only the folders that occur in
    ``df``) give the same table when run again; ``append`` adds the rows again.
    """
    with small_pieces(df.sparkSession):
        _laid_out(df, partition_by, sort_by, mode, cluster_by, bloom).save(path)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a catalog database unless it is there."""
    quoted = name.replace("`", "``")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{quoted}`" + (
        " LOCATION '{}'".format(location.replace("'", r"\'")) if location else ""
    ))


def save_as_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
    mode: str = "overwrite", cluster_by: Sequence[str] = (),
    bloom: Mapping[str, int] | None = None,
) -> None:
    """Write a catalog table, laid out as by :func:`write_table`."""
    with small_pieces(df.sparkSession):
        _laid_out(df, partition_by, sort_by, mode, cluster_by, bloom).saveAsTable(name)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
    mode: str = "overwrite", batch_size: int = 10_000, connections: int | None = None,
) -> None:
    """Write a database table, one connection per partition.

    ``connections`` bounds how many are open. ``overwrite`` empties the table and
    keeps its definition. Each partition commits on its own, so a task that is
    lost after its commit writes its rows twice: where that matters, write to a
    staging table and let the database move the rows.
    """
    writer = df.write.mode(mode).option("batchsize", batch_size).option("truncate", True)
    if connections:
        writer = writer.option("numPartitions", connections)
    writer.jdbc(url, table, properties=properties)


def write_result(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Keep a whole result as Parquet."""
    df.write.mode(mode).parquet(path)


def _versions(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return spark.read.schema(_VERSIONS).json(f"{root}/{name}_versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def latest_version(spark: SparkSession, root: str, name: str) -> tuple[int, str] | None:
    """Number and path of the newest published version."""
    versions = _versions(spark, root, name)
    if versions is None:
        return None
    newest = versions.agg(F.max(F.struct("version", "path")).alias("v")).first()["v"]
    return (newest["version"], newest["path"]) if newest else None


def publish_version(df: DataFrame, root: str, name: str) -> int:
    """Write ``df`` as the next version of a table, then point to it.

    Readers see the old version until the pointer row is written, so the source
    of ``df`` may be the version before. A try that failed leaves no pointer and
    is overwritten by the next one. One publisher per table at a time.
    """
    spark = df.sparkSession
    before = latest_version(spark, root, name)
    version = before[0] + 1 if before else 1
    path = f"{root}/{name}_v{version}"
    df.write.mode("overwrite").parquet(path)
    pointer = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.lit(path).alias("path"),
        F.current_timestamp().alias("committed_at"),
    )
    pointer.write.mode("append").json(f"{root}/{name}_versions")
    return version


def read_latest(spark: SparkSession, root: str, name: str, schema: str | None = None) -> DataFrame:
    """Newest published version of a table."""
    latest = latest_version(spark, root, name)
    if latest is None:
        raise ValueError(f"no published version of {name}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(latest[1])
