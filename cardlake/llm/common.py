"""Helpers the document operators share."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.plans.session import scratch_folder

# White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
# Rows of a small intermediate table that go to one task and file.
ROWS_EACH = 100_000
ARROW_ROWS = 500


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: tasks import it there.

    Rows of texts and sets may be large, so a session's larger Arrow batches, whose bytes
    Spark does not bound, are lowered to ``ARROW_ROWS``.
    """
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    context = spark.sparkContext
    if getattr(context, "_cardlake_sent", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="cardlake-"), "cardlake.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    archive.write(whole, os.path.relpath(whole, os.path.dirname(package)))
    context.addPyFile(path)
    context._cardlake_sent = True


def saved(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` computed once and kept as a table in the shared folder, its lineage cut.

    A table and no checkpoint: a checkpoint keeps the estimated size of its plan, and in
    loops the products of the estimates of joins soon fill the driver's memory. With
    ``rows``, what the table has at most, it is made by as many tasks as that needs, and
    has no more files.
    """
    path = f"{scratch_folder(df.sparkSession)}/table"
    (df if rows is None else packed(df, rows)).write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._cardlake_folder = path
    return kept


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of up to ``rows`` rows, in no more tasks than these need."""
    return df.coalesce(max(1, -(-rows // ROWS_EACH)))


def forget(*tables: DataFrame | None) -> None:
    """Delete the files of ``saved`` tables that nothing will read again."""
    for table in tables:
        path = getattr(table, "_cardlake_folder", None) if table is not None else None
        if path:
            spark = table.sparkSession
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
            files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            files.delete(place, True)
            files.cancelDeleteOnExit(place)
            table._cardlake_folder = None


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def on_files(df: DataFrame) -> DataFrame:
    """``df`` if it only selects from rows of Parquet files, else a kept copy of it."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = [re.sub(r"^[\s:+|-]*", "", line) for line in plan.splitlines()]
    files = [node for node in nodes if re.match(r"Relation .*\bparquet$", node)]
    others = {re.match(r"\w*", node)[0] for node in nodes if node and node not in files}
    return df if len(files) == 1 and others <= {"Project", "Filter"} else saved(df)


def with_row(df: DataFrame, name: str) -> DataFrame:
    """Number the rows by partition and place, for a table that is saved with the numbers.

    Read again, the same table may have other numbers: see ``numbered``.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, which is ``on_files``, with a number of each row that stays the same.

    A number is made of the place of the row's file among all paths and of the row's place
    in its file, so it does not depend on how Spark cuts files into tasks, which follows
    the number of cores present. Numbers keep the order of files and rows.
    """
    file = df.metadataColumn("_metadata")
    paths = sorted(r[0] for r in df.select(file["file_path"].alias("p")).distinct().collect())
    path, number = fresh(df, "file_path"), fresh(df, "file_number")
    # One row per file of the table, which the driver lists for each scan anyway.
    places = df.sparkSession.createDataFrame(pa.table({
        path: pa.array(paths, pa.string()), number: pa.array(range(len(paths)), pa.int64())}))
    located = df.select("*", file["file_path"].alias(path), file["row_index"].alias(name))
    return located.join(F.broadcast(places), path).select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.shiftleft(F.col(number), 36) + F.col(name)).alias(name))


def without_rows(df: DataFrame, dropped: DataFrame, row: str) -> DataFrame:
    """``df``, which is ``on_files``, without the rows whose number (see ``numbered``) is in
    ``dropped[row]``.

    The numbers are unique, so no key is hot; only the numbers are hashed, the
    texts are streamed past them unsorted.
    """
    name = fresh(df, "row_number")
    keys = dropped.select(F.col(row).alias(name)).hint("shuffle_hash")
    return numbered(df, name).join(keys, name, "left_anti").drop(name)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+", -1), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where lambdas use it."""
    return F.transform(F.array(value), body)[0]


def shuffle_partitions(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions for a shuffle of ``rows`` rows, ``rows_each`` in one at most on average."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))


def id_remainder(doc_id: str, divisor: int) -> Column:
    """CRC-32 of the id as text modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % divisor


def in_sample(doc_id: str, share: Column | float, salt: int = 0) -> Column:
    """Whether a row is in a sample of about ``share``, by hash of its id."""
    place = F.pmod(F.xxhash64(F.col(doc_id), F.lit(salt)), F.lit(1 << 30)) / (1 << 30)
    return place < share
