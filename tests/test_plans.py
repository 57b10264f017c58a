"""What Spark makes of the queries: pushed filters, broadcasts, shared shuffles, top-n."""

import re

import pytest
from pyspark.sql import functions as F

from cardlake.operators import lookups, model, rankings, reports, sizing, updates
from cardlake.plans import bank_views as bank
from cardlake.plans.queries import QUERIES
from cardlake.sources import schemas, writers
from cardlake.sources.readers import read_table


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def executed(df, capsys):
    df.collect()
    df.explain()
    # of the whole query; a subquery prints its own plans before
    return capsys.readouterr().out.split("\n+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", list(QUERIES))
def test_native_only(name, spark, sf_dir, capsys):
    text = plan(QUERIES[name](spark, sf_dir), capsys)
    for slow in ["Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"]:
        assert slow not in text
    # a window would gather its rows by key, or all of them
    assert not re.search(r"\bWindow\b", text)


def test_month_reaches_the_scan(spark, sf_dir, capsys):
    text = plan(QUERIES["monthly_bill_lines"](spark, sf_dir), capsys)
    assert re.search(r"GreaterThanOrEqual\(l_shipdate,1998-04-01", text)
    assert re.search(r"LessThan\(l_shipdate,1998-05-01", text)


def test_only_used_columns_are_read(spark, sf_dir, capsys):
    text = plan(QUERIES["month_counts"](spark, sf_dir), capsys)
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_shipdate:" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_month_folder_is_pruned_and_card_is_pushed(spark, sf_dir, tmp_path, capsys):
    path = str(tmp_path / "credit")
    writers.write_table(bank.txn(spark, sf_dir), path, ["txn_month"], ["CUST_CC_NO"])
    stored = read_table(spark, path, schemas.CREDIT)
    text = plan(reports.monthly_bill_lines(stored, 4000000000001378, 4, 1998), capsys)
    assert re.search(r"PartitionFilters: \[.*txn_month#\d+ = 199804", text)
    assert "EqualTo(CUST_CC_NO,4000000000001378)" in text
    text = plan(
        reports.transactions_between_dates(stored, 4000000000001378, "1998-04-02", "1998-05-01"),
        capsys,
    )
    assert re.search(r"PartitionFilters: \[.*txn_month#\d+ >= 199804", text)
    assert re.search(r"GreaterThanOrEqual\(TIMEID,19980402\)", text)


def test_zip_reaches_the_scan_of_customers(spark, sf_dir, tmp_path, capsys):
    path = str(tmp_path / "customer")
    writers.write_table(bank.customer(spark, sf_dir), path, sort_by=["SSN"])
    stored = read_table(spark, path, schemas.CUSTOMER)
    text = plan(reports.transactions_by_zip_month(
        bank.txn(spark, sf_dir), stored, bank.branch(spark, sf_dir), 7, 4, 1998
    ), capsys)
    assert "EqualTo(CUST_ZIP,00007)" in text
    text = plan(reports.account_details(stored, 7), capsys)
    assert "EqualTo(SSN,7)" in text


def test_small_dimensions_are_broadcast(spark, sf_dir, capsys):
    text = plan(QUERIES["branch_state_totals"](spark, sf_dir), capsys)
    assert "SortMergeJoin" not in text


def test_filter_on_type_is_below_the_joins(spark, sf_dir, capsys):
    text = plan(QUERIES["type_totals_one"](spark, sf_dir), capsys)
    assert "EqualTo(o_orderpriority,1-URGENT)" in text


def test_facts_are_shuffled_once_for_large_dimensions(spark, sf_dir, capsys):
    """The customers join the rows as they are; only the branches meet summed ones."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = reports.type_totals(
            bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir),
            max_broadcast_bytes=0,
        )
        rows.explain()
        text = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"HashAggregate\(keys=\[(.*?)\]\S*, functions=\[partial_sum", text)
    names = [sorted(re.findall(r"([A-Z_]+)#", k)) for k in keys]
    assert ["BRANCH_CODE", "TRANSACTION_TYPE"] in names
    assert not any("CUST_SSN" in n for n in names)


def test_nested_columns_count_by_their_content(spark):
    wide = spark.range(1000).select("id", F.array_repeat(F.lit("x" * 100), 10).alias("many"))
    assert not sizing.fits_broadcast(wide, 1_000_000)
    assert sizing.fits_broadcast(wide, 2_000_000)
    nested = wide.select(F.struct("many").alias("s"), F.create_map("id", "many").alias("m"))
    assert not sizing.fits_broadcast(nested, 2_000_000)


def test_tables_are_measured_once(spark, sf_dir, monkeypatch):
    measured = []
    real = sizing._measure
    monkeypatch.setattr(sizing, "_measure", lambda df: measured.append(df.columns) or real(df))
    tables = bank.customer(spark, sf_dir), bank.branch(spark, sf_dir)
    model.joined(bank.txn(spark, sf_dir), *tables)
    assert len(measured) == 2
    small = sizing.fit_broadcast(dict(zip(("customer", "branch"), tables, strict=True)))
    measured.clear()
    model.joined(bank.txn(spark, sf_dir), *tables, small=small)
    model.matched_totals(bank.txn(spark, sf_dir), *tables, "BRANCH_STATE", small=small)
    assert measured == []
    changes = bank.changes(spark, sf_dir)
    answer = updates.small_batch(changes)
    assert len(measured) == 1
    valid = updates.validate_changes(
        updates.normalize_changes(changes), tables[0], small=answer)
    updates.apply_updates(tables[0], updates.accepted(valid), small=answer)
    assert len(measured) == 1


@pytest.mark.parametrize("name", ["top_customers", "top_months", "top_branches_for_type"])
def test_rankings_keep_only_the_top_rows(name, spark, sf_dir, capsys):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf_dir), capsys)


def test_best_customer_is_one_broadcast_row(spark, sf_dir, capsys):
    text = executed(rankings.top_customer_breakdown(bank.txn(spark, sf_dir)), capsys)
    assert "TakeOrderedAndProject(limit=1" in text
    assert "SortMergeJoin" not in text
    # the totals per customer, and those per type of the best one
    shuffled = re.findall(r"hashpartitioning\((.*?), 8\)", text)
    assert {re.sub(r"#\d+L?", "", s) for s in shuffled} == {
        "CUST_SSN", "TRANSACTION_TYPE, _whole"
    }


@pytest.mark.parametrize("name", [
    "monthly_bill_lines", "transactions_between_dates", "transactions_by_zip_month",
])
def test_rows_are_kept_before_a_global_sort(name, spark, sf_dir, capsys):
    """The sampling of the sort reads shuffled rows, and not the sources again."""
    text = plan(QUERIES[name](spark, sf_dir), capsys)
    assert "REBALANCE_PARTITIONS_BY_NONE" in text
    assert "rangepartitioning(TIMEID" in text


def test_share_reuses_the_grouped_rows(spark, sf_dir, capsys):
    counts = bank.txn(spark, sf_dir).groupBy("TRANSACTION_TYPE").agg(F.count("*").alias("n"))
    text = executed(rankings.with_share(counts, "n"), capsys)
    assert re.search(r"ReusedExchange \[TRANSACTION_TYPE", text)


def test_size_check(spark):
    few = spark.range(100).withColumn("t", F.lit("x" * 10))
    assert sizing.fits_broadcast(few, 100 * 100)
    assert not sizing.fits_broadcast(few, 100 * 10)
    assert not sizing.fits_broadcast(few, 0)
    sizes = sizing.fit_broadcast({"a": few, "b": few.limit(0)}, 1000)
    assert sizes == {"a": False, "b": True}


@pytest.mark.parametrize("texts", [1, 8])
def test_broadcast_only_if_small(spark, texts, capsys):
    df = spark.range(100).select("id", *[F.lit("x" * 50).alias(f"t{i}") for i in range(texts)])
    row = 16 * (2 + texts) + 50 * texts
    for limit, hinted in [(100 * row, True), (100 * row - 1, False), (10, False), (0, False)]:
        sizing.broadcast_if_small(df, limit).explain("extended")
        assert ("ResolvedHint" in capsys.readouterr().out) == hinted


def test_totals_with_a_hot_customer(spark, capsys):
    """A third of all transactions are of one customer."""
    txn = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("CUST_SSN"),
        (F.col("id") % 5).alias("BRANCH_CODE"),
        F.when(F.col("id") % 2 == 0, "Gas").otherwise("Bills").alias("TRANSACTION_TYPE"),
        F.lit("0.01").cast("decimal(18,2)").alias("TRANSACTION_VALUE"),
    )
    customer = spark.range(300_000).select(F.col("id").alias("SSN"))
    branch = spark.range(5).select(
        F.col("id").alias("BRANCH_CODE"), F.col("id").cast("string").alias("BRANCH_STATE")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        small = reports.type_totals(txn, customer, branch).collect()
        large = reports.type_totals(txn, customer, branch, max_broadcast_bytes=0).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small == large
    assert sorted(map(tuple, large)) == [("Bills", 150_000, 1500.0), ("Gas", 150_000, 1500.0)]


@pytest.fixture
def small_pieces(spark):
    """Thresholds at which adaptive execution acts on test data."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    }
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key in changed:
        spark.conf.unset(key)


def hot_rows(spark, path, key, rest):
    """400,000 rows, a third of them with key 1."""
    spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias(key), *rest
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_customer_of_the_row_join_is_split(spark, tmp_path, small_pieces, capsys):
    """Where rows cannot be summed first, the hot key's rows go to several tasks."""
    note = F.sha2(F.col("id").cast("string"), 256)
    txn = hot_rows(spark, str(tmp_path / "txn"), "CUST_SSN", [note.alias("note")])
    customer = spark.range(400_000).select(F.col("id").alias("SSN"), note.alias("name"))
    rows = model.join_customer(txn, customer, max_broadcast_bytes=0)
    assert "skew=true" in executed(rows.select("CUST_SSN", "name", "note"), capsys)


def test_hot_customer_of_totals_is_split(spark, tmp_path, small_pieces, capsys):
    txn = hot_rows(spark, str(tmp_path / "txn"), "CUST_SSN", [
        (F.col("id") % 5).alias("BRANCH_CODE"), F.sha2(F.col("id").cast("string"), 256).alias("note"),
        F.col("id").cast("decimal(18,2)").alias("TRANSACTION_VALUE"),
    ])
    customer = spark.range(400_000).select(F.col("id").alias("SSN"))
    branch = spark.range(5).select(F.col("id").alias("BRANCH_CODE"))
    rows = model.matched_totals(txn, customer, branch, "note", max_broadcast_bytes=0)
    assert "skew=true" in executed(rows, capsys)


@pytest.mark.parametrize("operator, rows", [
    (lookups.known_keys, 400_000), (lookups.unknown_keys, 0)
])
def test_hot_request_is_split(operator, rows, spark, tmp_path, small_pieces, capsys):
    note = F.sha2(F.col("id").cast("string"), 256)
    requests = hot_rows(spark, str(tmp_path / "asked"), "k", [note.alias("note")])
    known = hot_rows(spark, str(tmp_path / "known"), "v", [])
    found = operator(requests, "k", known, "v")
    assert "skew=true" in executed(found, capsys)
    assert found.count() == rows


def test_hot_customer_of_a_batch_of_edits_is_split(spark, tmp_path, small_pieces, capsys):
    changes = hot_rows(spark, str(tmp_path / "changes"), "SSN", [
        F.lit("CUST_CITY").alias("field"), F.col("id").alias("seq"),
        F.regexp_replace(F.sha2(F.col("id").cast("string"), 256), "[0-9]", "").alias("new_value"),
    ])
    customer = spark.range(400_000).select(F.col("id").alias("SSN"))
    valid = updates.validate_changes(changes, customer, max_broadcast_bytes=0)
    assert "skew=true" in executed(valid, capsys)
    assert updates.accepted(valid).count() == 400_000
