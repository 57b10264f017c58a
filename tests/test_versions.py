"""Loads that show whole or not at all, edits and summaries that follow them."""

import os
import re

import pytest
from pyspark.sql import functions as F

from cardlake.operators import rankings, reports
from cardlake.plans import bank_views as bank
from cardlake.plans import bucketed, summaries
from cardlake.plans.edits import edit_customers
from cardlake.plans.etl import (
    KEY_RANGE, LAYOUT, key_range, load_table, open_table, path_sink, run_etl,
)
from cardlake.sources import schemas, versions, writers
from cardlake.sources.readers import read_table
from tests import bank_data


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark):
    def made(*pairs):
        return spark.createDataFrame(list(pairs), "k BIGINT, p STRING")
    return made


def test_modes_of_a_versioned_table(spark, table, tmp_path):
    root = str(tmp_path)
    for mode, df, expected in [
        ("overwrite", table((1, "a"), (2, "b")), [(1, "a"), (2, "b")]),
        ("append", table((3, "b"), (4, None)), [(1, "a"), (2, "b"), (3, "b"), (4, None)]),
        ("replace_partitions", table((5, "b"), (6, None)), [(1, "a"), (5, "b"), (6, None)]),
        ("replace_partitions", table(), [(1, "a"), (5, "b"), (6, None)]),
        ("overwrite", table((7, "c")), [(7, "c")]),
        ("overwrite", table(), []),
        ("append", table((8, "c")), [(8, "c")]),
    ]:
        versions.publish(df, root, "t", mode, ["p"])
        assert rows(versions.read(spark, root, "t", "k BIGINT, p STRING")) == sorted(expected, key=str)
    assert versions.versions(spark, root, "t") == [1, 2, 3, 4, 5, 6, 7]
    assert rows(versions.read(spark, root, "t", "k BIGINT, p STRING", version=3)) == [
        (1, "a"), (5, "b"), (6, None)]
    with pytest.raises(ValueError):
        versions.publish(table(), root, "t", "merge")


def test_a_table_may_be_its_own_source(spark, table, tmp_path):
    root = str(tmp_path)
    versions.publish(table((1, "a"), (2, "b")), root, "t")
    for _ in range(2):
        old = versions.read(spark, root, "t", "k BIGINT, p STRING")
        versions.publish(old.withColumn("k", F.col("k") * 10), root, "t")
    assert rows(versions.read(spark, root, "t", "k BIGINT, p STRING")) == [(100, "a"), (200, "b")]


def test_a_write_that_fails_midway_leaves_the_old_table(spark, tmp_path):
    paths, root = bank_data.write_bank(tmp_path), str(tmp_path / "warehouse")
    run_etl(spark, paths, root)
    before = {t: rows(open_table(spark, root, t)) for t in ("credit", "customer")}
    for table in before:
        stored = open_table(spark, root, table).repartition(4)
        failing = stored.withColumn(stored.columns[0], F.when(
            F.spark_partition_id() < 3, F.col(stored.columns[0])).otherwise(
            F.raise_error(F.lit("a task fails")).cast(stored.schema[0].dataType)))
        with pytest.raises(Exception, match="a task fails"):
            path_sink(root)(failing, table, "overwrite")
        assert rows(open_table(spark, root, table)) == before[table]
    run_etl(spark, paths, root)  # over the folder of the load that failed
    assert rows(open_table(spark, root, "credit")) == before["credit"]


def test_readers_of_the_version_before_are_not_disturbed(spark, tmp_path):
    paths, root = bank_data.write_bank(tmp_path), str(tmp_path / "warehouse")
    run_etl(spark, {"credit": paths["credit"]}, root)
    reader = open_table(spark, root, "credit")
    again = bank_data.write_lines(tmp_path / "again.json", bank_data.CREDITS[:1])
    run_etl(spark, {"credit": again}, root)
    assert reader.count() == 9 and open_table(spark, root, "credit").count() == 1


def test_old_versions_go_and_what_is_used_stays(spark, table, tmp_path):
    root = str(tmp_path)
    for n, name in enumerate("abcd"):
        versions.publish(table((n, name)), root, "t", "append" if n else "overwrite", ["p"])
    versions.publish(table((9, "b")), root, "t", "replace_partitions", ["p"])
    assert versions.vacuum(spark, root, "t", keep=1) == 1
    assert versions.versions(spark, root, "t") == [5]
    assert rows(versions.read(spark, root, "t", "k BIGINT, p STRING")) == [
        (0, "a"), (2, "c"), (3, "d"), (9, "b")]
    assert versions.vacuum(spark, root, "t", keep=1) == 0


def test_two_publishers_are_noticed(spark, table, tmp_path, monkeypatch):
    root = str(tmp_path)
    versions.publish(table((1, "a")), root, "t")
    stale = versions.versions(spark, root, "t")
    versions.publish(table((2, "a")), root, "t")
    monkeypatch.setattr(versions, "versions", lambda *_: stale)
    with pytest.raises(RuntimeError):
        versions.publish(table((3, "a")), root, "t")


def test_tables_without_versions_are_read_as_they_lie(spark, table, tmp_path):
    writers.write_table(table((1, "a")), f"{tmp_path}/t", ["p"])
    assert rows(versions.read(spark, str(tmp_path), "t", "k BIGINT, p STRING")) == [(1, "a")]
    versions.publish(table(), str(tmp_path), "none", partition_by=["p"])
    with pytest.raises(ValueError):
        versions.read(spark, str(tmp_path), "none")


def test_month_folder_of_a_version_is_pruned(spark, sf_dir, tmp_path, capsys):
    root = str(tmp_path)
    versions.publish(bank.txn(spark, sf_dir), root, "credit", **LAYOUT["credit"])
    one = reports.monthly_bill_lines(open_table(spark, root, "credit"), 4000000000001378, 4, 1998)
    one.explain("formatted")
    text = capsys.readouterr().out
    assert re.search(r"PartitionFilters: \[.*txn_month#\d+ = 199804", text)


@pytest.mark.parametrize("key, expected", [(0, 0), (99, 0), (100, 1), (-1, -1), (None, None)])
def test_key_ranges(spark, key, expected):
    df = spark.createDataFrame([(key,)], "k BIGINT").select(key_range(F.col("k"), 100).alias("r"))
    assert df.first()["r"] == expected


@pytest.fixture
def customers(spark, sf_dir, tmp_path):
    root = str(tmp_path / "warehouse")
    path_sink(root, keys_each=100)(bank.customer(spark, sf_dir), "customer", "overwrite")
    return root


def test_edits_rewrite_only_the_folders_they_touch(spark, customers):
    before, old = files(f"{customers}/customer"), rows(open_table(spark, customers, "customer"))
    changes = spark.createDataFrame([
        (205, "CUST_CITY", "springfield", 1), (207, "CUST_ZIP", "123", 2), (905, "SHOE", "4", 3),
        (999999, "CUST_CITY", "Nowhere", 4), (None, "CUST_CITY", "Nowhere", 5),
    ], schemas.CHANGES)
    counts = edit_customers(spark, customers, changes, "b1", keys_each=100)
    assert counts == {"accepted": 1, "refused": 4, "folders": 1}
    parts = versions.folders(spark, customers, "customer")
    assert [p for p in parts if p.startswith("load_number=2")] == ["load_number=2/key_range=2"]
    used = {f for p in parts for f in files(f"{customers}/customer/{p}")}
    assert {f for f in before if "key_range=2/" not in f} <= used
    now = {r.SSN: r for r in open_table(spark, customers, "customer").collect()}
    assert now[205].CUST_CITY == "Springfield" and len(now) == len(old) == 1500
    assert sorted(map(str, (tuple(r) for r in now.values() if r.SSN != 205))) == [
        str(r) for r in old if r[0] != 205]
    refused = read_table(spark, f"{customers}/quarantined/customer/batch=b1")
    assert {r.SSN: r.reason for r in refused.collect()} == {
        207: "bad value", 905: "unknown field", 999999: "unknown SSN", None: "unknown SSN"}


def test_a_batch_without_an_accepted_edit_changes_nothing(spark, customers):
    changes = spark.createDataFrame([(1, "CUST_ZIP", "x", 1)], schemas.CHANGES)
    assert edit_customers(spark, customers, changes, "b", keys_each=100) == {
        "accepted": 0, "refused": 1, "folders": 0}
    assert versions.versions(spark, customers, "customer") == [1]
    empty = spark.createDataFrame([], schemas.CHANGES)
    assert edit_customers(spark, customers, empty, "e", keys_each=100)["folders"] == 0


def test_customers_of_other_folders_are_not_read(spark, customers, capsys):
    table = versions.read(spark, customers, "customer", schemas.CUSTOMER + f", {KEY_RANGE} BIGINT")
    table.filter(F.col(KEY_RANGE).isin([3])).explain("formatted")
    assert re.search(r"PartitionFilters: \[.*key_range#\d+L = 3", capsys.readouterr().out)


def _same_as_asked_of_all(spark, root):
    credit = open_table(spark, root, "credit")
    assert rows(summaries.monthly_bills(spark, root)) == rows(reports.monthly_bills(credit))
    assert rows(summaries.customer_totals(spark, root)) == rows(rankings.customer_totals(credit))
    assert rows(summaries.month_counts(spark, root)) == rows(rankings.month_counts(credit))
    assert summaries.top_customers(spark, root).collect() == rankings.top_customers(credit).collect()
    assert summaries.top_months(spark, root).collect() == rankings.top_months(credit).collect()
    for field, kind in [("TRANSACTION_TYPE", "string"), ("CUST_SSN", "bigint"), ("BRANCH_CODE", "bigint")]:
        assert rows(summaries.domain(spark, root, field, kind)) == rows(credit.select(field).distinct())
    assert rows(summaries.domain(spark, root, "year")) == rows(
        credit.select(F.substring("TIMEID", 1, 4)).distinct())


def test_summaries_follow_the_loads(spark, tmp_path):
    paths, root = bank_data.write_bank(tmp_path), str(tmp_path / "warehouse")
    sink, records = path_sink(root, summarize=True), bank_data.CREDITS

    def load(name, lines, mode):
        path = bank_data.write_lines(tmp_path / name, lines)
        load_table(spark, "credit", path, root, mode, sink=sink)
        _same_as_asked_of_all(spark, root)

    load_table(spark, "credit", paths["credit"], root, sink=sink)
    _same_as_asked_of_all(spark, root)
    untouched = versions.folders(spark, root, "card_months")
    first = dict(records[0], TRANSACTION_TYPE="Toys")
    load("a.json", [first], "replace_partitions")
    assert rows(summaries.domain(spark, root, "TRANSACTION_TYPE")).count(("Toys",)) == 1
    month = f"txn_month={first['YEAR']}{first['MONTH']:02d}"
    now = versions.folders(spark, root, "card_months")
    assert set(untouched) - set(now) == {f"load_number=1/{month}"}
    load("b.json", [records[0]], "replace_partitions")  # the last month with Toys is replaced
    assert ("Toys",) not in rows(summaries.domain(spark, root, "TRANSACTION_TYPE"))
    load("c.json", [records[1], dict(records[1], MONTH=77)], "append")
    load("d.json", records[:2], "overwrite")
    load("e.json", [], "overwrite")
    with pytest.raises(ValueError):
        summaries.domain(spark, root, "TRANSACTION_VALUE")


def test_summaries_are_left_alone_where_nothing_changed(spark, tmp_path):
    paths, root = bank_data.write_bank(tmp_path), str(tmp_path / "warehouse")
    load_table(spark, "credit", paths["credit"], root, sink=path_sink(root, summarize=True))
    parts = versions.folders(spark, root, "credit")
    assert summaries.refresh(spark, root, parts) == []
    assert len(summaries.refresh(spark, root, parts[1:])) == 1


def _database(tmp_path):
    return "bucketed_" + re.sub(r"\W", "_", os.path.basename(str(tmp_path))), str(tmp_path / "db")


def test_bucketed_sides_are_joined_without_a_shuffle(spark, sf_dir, tmp_path, capsys):
    database, location = _database(tmp_path)
    bucketed.store_bucketed(
        spark, bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), database, 8, location)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if there were many customers
    try:
        joined = bucketed.join_customer(spark, database)
        joined.explain()
        text = capsys.readouterr().out
        assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text
        assert joined.count() == bank.txn(spark, sf_dir).count()
        totals = bucketed.matched_totals(spark, database, bank.branch(spark, sf_dir), "BRANCH_STATE")
        totals.explain()
        text = capsys.readouterr().out
        below = text[text.index("SortMergeJoin"):]
        assert "Exchange hashpartitioning(CUST_SSN" not in below and "hashpartitioning(SSN" not in below
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_a_hot_customer_is_kept_out_of_the_buckets(spark, tmp_path):
    database, location = _database(tmp_path)
    credit = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("CUST_SSN"),
        F.lit(1).cast("bigint").alias("BRANCH_CODE"), F.lit("Gas").alias("TRANSACTION_TYPE"),
        F.lit(2).cast("decimal(18,2)").alias("TRANSACTION_VALUE"))
    credit = credit.union(credit.limit(1).withColumn("CUST_SSN", F.lit(None).cast("bigint")))
    customer = spark.range(400).select(F.col("id").alias("SSN"), F.lit("x").alias("LAST_NAME"))
    branch = spark.createDataFrame([(1, "NY")], "BRANCH_CODE BIGINT, BRANCH_STATE STRING")
    bucketed.store_bucketed(spark, credit, customer, database, 16, location)
    try:
        assert rows(spark.table(f"{database}.hot_customer")) == [(7,)]
        assert spark.table(f"{database}.credit_of_hot_customers").count() == credit.filter(
            "CUST_SSN = 7").count()
        expected = credit.filter("CUST_SSN < 400").count()
        assert bucketed.join_customer(spark, database).count() == expected
        found = bucketed.matched_totals(spark, database, branch, "BRANCH_STATE")
        assert [(r.BRANCH_STATE, r.n, r.total) for r in found.collect()] == [
            ("NY", expected, 2 * expected)]
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _read_rows(df):
    """Rows that the scan of ``df`` gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_absent_keys_read_no_row_group(spark, tmp_path):
    path, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    table = spark.range(0, 200_000, 1, 2).select(
        (F.col("id") * 7919 % 200_003 * 2).alias("TRANSACTION_ID"),
        F.xxhash64("id").alias("CUST_SSN"), F.lit("201801").alias("m"))
    writers.write_table(table, path, ["m"], bloom={"TRANSACTION_ID": 100_000, "CUST_SSN": 100_000})
    writers.write_table(table, plain, ["m"])

    def looked_up(where, key):
        return _read_rows(read_table(spark, where).filter(F.col("TRANSACTION_ID") == key))

    assert looked_up(plain, 50_001) > 0
    assert sum(looked_up(path, key) > 0 for key in range(50_001, 50_041, 2)) <= 3
    present = table.first()["TRANSACTION_ID"]
    assert read_table(spark, path).filter(F.col("TRANSACTION_ID") == present).count() == 1


def test_only_the_named_folders_are_listed(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 50).alias("p"))
    versions.publish(rows, root, "t", "overwrite", ["p"])
    listing = spark.conf.get(versions._LISTING)
    found = versions.read(spark, root, "t", "k BIGINT, p BIGINT", only={"p=3", "p=49", "p=77"})
    assert sorted(map(tuple, found.collect())) == [(3, 3), (49, 49)]
    assert all("/p=3/" in f or "/p=49/" in f for f in found.inputFiles())
    assert versions.read(spark, root, "t", "k BIGINT, p BIGINT", only=set()).count() == 0
    assert versions.read(spark, root, "t", "k BIGINT, p BIGINT").count() == 50
    assert spark.conf.get(versions._LISTING) == listing
