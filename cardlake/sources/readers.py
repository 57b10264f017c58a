"""Readers: JSON files, Parquet tables, JDBC."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from cardlake.sources.json_arrays import array_elements
from cardlake.sources.schemas import CORRUPT_COLUMN, OTHER_FIELDS


def _field(name: str) -> str:
    """Path of a top-level field within a variant."""
    quote = "'" if '"' in name else '"'
    return f"$[{quote}{name}{quote}]"


def _struct(fields: dict[str, str]) -> str:
    """The type of a struct with these fields."""
    return "struct<{}>".format(", ".join(
        "`{}`: {}".format(name.replace("`", "``"), kind) for name, kind in fields.items()))


def _records(lines: DataFrame, schema: str) -> DataFrame:
    """Records of texts ``value`` that hold one JSON object each.

    A text is parsed once, into a variant, whatever is asked for later: the step that
    does it makes rows, which filters on the outcome are not moved below. The declared fields
    are taken out of the variant together. Only where they are not all that the object has
    are its fields looked at one by one. A record is bad if its text is no object or if a
    declared field has a value that its type cannot hold.
    """
    declared = StructType.fromDDL(schema)
    kinds = {field.name: field.dataType.simpleString() for field in declared}
    whole_numbers = [f.name for f in declared if isinstance(f.dataType, IntegralType)]
    record = F.col("_record")
    read = lines.select("value", F.explode(F.array(F.try_parse_json("value"))).alias("_record"))
    taken = [F.try_variant_get(record, "$", _struct(kinds)).alias("_got"),
             F.size(F.json_object_keys("value")).alias("_names")]
    if whole_numbers:
        taken.append(F.try_variant_get(
            record, "$", _struct(dict.fromkeys(whole_numbers, "double"))).alias("_double"))
    read = read.select("value", "_record", F.inline(F.array(F.struct(*taken))))
    columns, failed, lost, found = [], F.lit(False), F.lit(False), F.lit(0)
    for field in declared:
        got = F.col("_got")[field.name]
        there = F.try_variant_get(record, _field(field.name), "variant")
        lost = lost | (got.isNull() & there.isNotNull() & ~F.is_variant_null(there))
        if field.name in whole_numbers:  # a fraction would be cut off
            failed = failed | F.coalesce(F.col("_double")[field.name] != got, F.lit(False))
        columns.append(got.alias(field.name))
        found = found + got.isNotNull().cast("int")
    plain = F.coalesce(F.col("_got").isNotNull() & (F.col("_names") == found), F.lit(False))
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    others = F.map_filter(fields, lambda name, _: ~name.isin(declared.fieldNames()))
    as_text = F.transform_values(others, lambda _, v: F.try_variant_get(v, "$", "string"))
    # What stands behind the first condition is not worked out for plain records.
    bad = F.when(plain, failed).otherwise(fields.isNull() | failed | F.coalesce(lost, F.lit(False)))
    return read.select(
        *columns, F.when(plain, F.lit(None)).when(F.size(others) > 0, as_text).alias(OTHER_FIELDS),
        F.when(bad, F.col("value")).alias(CORRUPT_COLUMN))


def read_json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON, one record per line; files are split between tasks.

    Lines that do not parse come back with null fields, lines with a value that does not
    fit its type with a null there, and both with their text in ``_corrupt_record``. Numbers
    written as text are read as numbers, and a name that comes twice makes a line bad.
    Fields that the schema does not name are kept as text in the map ``other_fields``, null
    where there are none. Blank lines are no records.
    """
    lines = spark.read.text(path).filter(F.col("value").rlike(r"\S"))
    return _records(lines, schema)


# Array files from this size on are cut between tasks.
SPLIT_BYTES = 128 << 20


def _begins_array(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = files.open(place)
    try:
        return bytes(stream.readNBytes(4096)).lstrip()[:1] == b"["
    finally:
        stream.close()


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: str, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """JSON files that each hold one array of records, or one record.

    A file below ``split_bytes`` is one task; a larger array is cut at the borders of its
    records (see :mod:`cardlake.sources.json_arrays`). The records come as those of
    :func:`read_json_lines`. A file that does not parse comes as one bad record with its
    whole text; of a large one, only the records that do not parse are bad.
    """
    sizes = spark.read.format("binaryFile").load(path).select("path", "length")
    large = [r["path"] for r in sizes.filter(F.col("length") >= split_bytes).collect()]
    large = [p for p in large if _begins_array(spark, p)]
    parts = []
    if large:
        small = [r["path"] for r in sizes.select("path").collect() if r["path"] not in set(large)]
        parts.append(array_elements(spark, large))
    else:
        small = path
    if small:
        texts = spark.read.text(small, wholetext=True).filter(F.col("value").rlike(r"\S"))
        elements = F.when(F.col("value").rlike(r"^\s*\{"), F.array("value")).otherwise(
            F.from_json("value", "array<string>")
        )
        whole = F.coalesce(elements, F.array("value"))
        parts.append(texts.select(F.explode(whole).alias("value")))
    return _records(reduce(DataFrame.union, parts), schema)


def read_table(
    spark: SparkSession, path: str, schema: str | StructType | None = None
) -> DataFrame:
    """Parquet table. With a schema, partition values keep their declared type."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    num_partitions: int | None = None,
    bounds: tuple | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Database table.

    With a numeric, date or timestamp ``column`` the read is cut into
    ``num_partitions`` ranges that are fetched in parallel; bounds not given
    are asked from the database in one query. Bounds only place the cuts: rows
    outside of them, and nulls, are read as well. Without ``column`` one task
    reads the table, which is warned of. ``fetch_size`` rows come in one round trip.
    """
    properties = {"fetchsize": str(fetch_size)} | (properties or {})
    if not column:
        warnings.warn(f"one task reads all of {table}: name a column to cut it by", stacklevel=2)
        return spark.read.jdbc(url, table, properties=properties)
    if not num_partitions:
        raise ValueError("num_partitions is needed with column")
    if not bounds:
        asked = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) asked"
        # by position: databases differ in the case of column names
        bounds = tuple(spark.read.jdbc(url, asked, properties=properties).first())
    low, high = bounds
    if low is None:  # no row with a value: nothing to cut
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url, table, column=column, lowerBound=str(low), upperBound=str(high),
        numPartitions=num_partitions, properties=properties,
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, and the texts of those that did not."""
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    return df.filter(~bad).drop(CORRUPT_COLUMN), df.filter(bad)
