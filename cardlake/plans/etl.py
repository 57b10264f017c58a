"""The load: raw JSON files to cleaned warehouse tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardlake.functions import dates, text
from cardlake.plans import summaries
from cardlake.sources import schemas, versions
from cardlake.sources.readers import read_json_array, read_json_lines, read_table, split_corrupt
from cardlake.sources.writers import ensure_database, save_as_table, write_jdbc, write_table

TABLES = ["branch", "credit", "customer", "loan"]
# How tables are kept: facts in one folder per month, in files that hold ranges of cards
# (of a card with very many transactions, ranges of these); customers in ranges of their key.
LAYOUT = {
    "credit": {
        "partition_by": ["txn_month"], "cluster_by": ["CUST_CC_NO", "TRANSACTION_ID"],
        "sort_by": ["CUST_CC_NO", "TRANSACTION_ID"],
    },
    "customer": {"cluster_by": ["SSN"], "sort_by": ["SSN"]},
}
# Below a folder, customers lie in one folder per range of so many keys, so that a batch of
# edits rewrites the ranges it touches and no others.
KEY_RANGE = "key_range"
KEYS_EACH = 1_000_000

# Takes a cleaned table, its name and the mode, stores it, and gives it back as stored,
# or None where it cannot be read back.
Sink = Callable[[DataFrame, str, str], DataFrame | None]


def with_key_range(customer: DataFrame, keys_each: int = KEYS_EACH) -> DataFrame:
    return customer.withColumn(KEY_RANGE, key_range(F.col("SSN"), keys_each))


def key_range(ssn: Column, keys_each: int = KEYS_EACH) -> Column:
    """Number of the range of keys; null for a null key."""
    return F.floor((ssn - F.pmod(ssn, F.lit(keys_each))) / keys_each).cast("bigint")


def path_sink(
    root: str, keys_each: int = KEYS_EACH, keep: int = 2, summarize: bool = False,
    bloom: Mapping[str, int] | None = None,
) -> Sink:
    """Parquet tables below a folder, each switched to at once when it is whole.

    The newest ``keep`` versions stay readable. With ``summarize`` the summaries of the
    transactions (:mod:`cardlake.plans.summaries`) follow the months that a load changed;
    all loads of a folder should then ask for it. ``bloom`` names keys that transactions are
    looked up by and files are not ordered by (see ``write_table``); a filter takes over a
    byte for each value expected in a row group, so it suits months of many rows.
    """
    def store(df: DataFrame, table: str, mode: str) -> DataFrame:
        spark, layout = df.sparkSession, dict(LAYOUT.get(table, {}))
        schema = df.schema
        if table == "customer":
            df = with_key_range(df, keys_each)
            layout["partition_by"] = [KEY_RANGE]
            mode = "append" if mode == "append" else "overwrite"
        if table == "credit" and bloom:
            layout["bloom"] = bloom
        before = versions.folders(spark, root, table) or []
        versions.publish(df, root, table, mode, **layout)
        versions.vacuum(spark, root, table, keep)
        stored = versions.read(spark, root, table, df.schema).select(*schema.fieldNames())
        if table == "credit" and summarize:
            summaries.refresh(spark, root, before, keep)
        return stored
    return store


def catalog_sink(database: str, location: str | None = None) -> Sink:
    """Tables of a catalog database, which is made if need be."""
    def store(df: DataFrame, table: str, mode: str) -> DataFrame:
        ensure_database(df.sparkSession, database, location)
        quoted = database.replace("`", "``")
        name = f"`{quoted}`.`{table}`"
        save_as_table(df, name, mode=mode, **LAYOUT.get(table, {}))
        return df.sparkSession.table(name)
    return store


def jdbc_sink(url: str, properties: dict[str, str] | None = None, **options) -> Sink:
    """Tables of a database; further fields go as JSON text."""
    def store(df: DataFrame, table: str, mode: str) -> None:
        if schemas.OTHER_FIELDS in df.columns:
            df = df.withColumn(schemas.OTHER_FIELDS, F.to_json(schemas.OTHER_FIELDS))
        write_jdbc(df, url, table, properties, mode=mode, **options)
    return store


def clean_branch(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "BRANCH_ZIP": text.default_zip(F.col("BRANCH_ZIP")),
        "BRANCH_PHONE": text.format_phone(F.col("BRANCH_PHONE")),
        "LAST_UPDATED": dates.parse_timestamp(F.col("LAST_UPDATED")),
    })


def clean_credit(raw: DataFrame) -> DataFrame:
    timeid = dates.compose_timeid(F.col("YEAR"), F.col("MONTH"), F.col("DAY"))
    return (
        raw.withColumn("TIMEID", timeid)
        .withColumns({
            "txn_date": dates.timeid_date(F.col("TIMEID")),
            "txn_month": dates.month_key(F.col("TIMEID")),
        })
        .drop("YEAR", "MONTH", "DAY")
        .withColumnRenamed("CREDIT_CARD_NO", "CUST_CC_NO")
    )


def clean_customer(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "FIRST_NAME": text.title_case(F.col("FIRST_NAME")),
        "MIDDLE_NAME": F.lower("MIDDLE_NAME"),
        "LAST_NAME": text.title_case(F.col("LAST_NAME")),
        "CUST_PHONE": text.format_phone(F.col("CUST_PHONE")),
        "FULL_STREET_ADDRESS": text.full_address(F.col("STREET_NAME"), F.col("APT_NO")),
        "CUST_ZIP": text.padded_zip(F.col("CUST_ZIP")),
        "LAST_UPDATED": dates.parse_timestamp(F.col("LAST_UPDATED")),
    }).drop("APT_NO", "STREET_NAME")


RAW_SCHEMAS = {
    "branch": schemas.RAW_BRANCH, "credit": schemas.RAW_CREDIT, "customer": schemas.RAW_CUSTOMER,
    "loan": schemas.RAW_LOAN,
}
TABLE_SCHEMAS = {
    "branch": schemas.BRANCH, "credit": schemas.CREDIT, "customer": schemas.CUSTOMER,
}


def read_raw(
    spark: SparkSession, table: str, path: str | list[str], schema: str | None = None
) -> DataFrame:
    """Raw records of one of the four tables.

    A schema of the caller's may name more columns than the usual ones; cleaning
    keeps them. Fields that it does not name come in the map ``other_fields``.
    """
    read = read_json_array if table == "loan" else read_json_lines
    return read(spark, path, schema or RAW_SCHEMAS[table])


def clean(table: str, raw: DataFrame) -> DataFrame:
    """Cleaned rows of one of the four tables; loans stay as they are."""
    steps = {"branch": clean_branch, "credit": clean_credit, "customer": clean_customer}
    return steps[table](raw) if table in steps else raw


def _any_rejected(seen: Observation) -> bool:
    try:
        return seen.get["rejected"] > 0
    except Py4JJavaError as e:
        # Adaptive execution drops the note together with a shuffle that no row came
        # through: nothing is known then. Other failures are not for here.
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return True


def load_name(path: str | list[str]) -> str:
    """What a load's rejects are kept under: the same for the same files."""
    paths = [path] if isinstance(path, str) else sorted(path)
    return hashlib.sha256("\n".join(paths).encode()).hexdigest()[:16]


def load_table(
    spark: SparkSession, table: str, path: str | list[str], root: str, mode: str = "overwrite",
    schema: str | None = None, load: str | None = None, sink: Sink | None = None,
) -> dict[str, int | None]:
    """Load one table into ``root/table``, or to another ``sink``; return how many rows it
    then has, and of this load how many records were rejected.

    Records that do not parse go to ``root/rejected/table/load=...``: under the name of
    the load, by default that of its files, so a load that is run again replaces its own
    and no other's. The load notes whether there are any, so only then are the files
    read again. Transactions without a valid day are kept with null keys and counted as
    ``undated``. The counts are of the stored tables: what is noted on the way counts
    the records of a lost executor twice.
    """
    raw = read_raw(spark, table, path, schema)
    seen = Observation()
    good, _ = split_corrupt(
        raw.observe(seen, F.count(schemas.CORRUPT_COLUMN).alias("rejected"))
    )
    stored = (sink or path_sink(root))(clean(table, good), table, mode)
    _, bad = split_corrupt(raw)
    if not _any_rejected(seen):
        bad = spark.createDataFrame([], bad.schema)
    rejects = f"{root}/rejected/{table}/load={load or load_name(path)}"
    write_table(bad, rejects)
    counts = {
        "rows": None if stored is None else stored.count(),
        "rejected": read_table(spark, rejects, bad.schema).count(),
    }
    if table == "credit" and stored is not None:
        counts["undated"] = stored.filter(F.col("txn_month").isNull()).count()
    return counts


def run_etl(
    spark: SparkSession, paths: Mapping[str, str | list[str]], root: str,
    mode: str = "overwrite", raw_schemas: Mapping[str, str] | None = None,
    sink: Sink | None = None,
) -> dict[str, dict[str, int | None]]:
    """Load the tables named in ``paths`` (of branch, credit, customer, loan); return
    the row counts of each.

    With the default mode a rerun gives the same warehouse; ``append`` adds the
    records again, ``replace_partitions`` replaces the months that are brought, and
    the tables without months whole. ``sink`` takes the tables elsewhere than below
    ``root``: see ``catalog_sink`` and ``jdbc_sink``.
    """
    return {
        table: load_table(
            spark, table, paths[table], root, mode, (raw_schemas or {}).get(table), sink=sink)
        for table in TABLES
        if table in paths
    }


def open_table(
    spark: SparkSession, root: str, table: str, schema: str | None = None,
    other_fields: bool = False,
) -> DataFrame:
    """A loaded table, with its declared types, or those of the caller's schema.

    ``other_fields`` adds the map of the fields that the declared schema does not name;
    loans have it always.
    """
    schema = schema or TABLE_SCHEMAS.get(table)
    if schema and other_fields:
        schema += f", {schemas.OTHER_FIELDS} MAP<STRING, STRING>"
    stored = versions.read(spark, root, table, schema)
    return stored.drop(KEY_RANGE) if table == "customer" else stored
