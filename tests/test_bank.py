"""Load of a small bank, and every question on it, with the rows written out."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cardlake.operators import loans, lookups, model, rankings, reports
from cardlake.plans.etl import catalog_sink, jdbc_sink, open_table, run_etl
from cardlake.sources import schemas
from cardlake.sources.writers import read_latest
from tests import bank_data


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bank")
    counts = run_etl(spark, bank_data.write_bank(folder), str(folder / "warehouse"))
    assert counts == {
        "branch": {"rows": 3, "rejected": 0}, "credit": {"rows": 9, "rejected": 0, "undated": 0},
        "customer": {"rows": 4, "rejected": 0}, "loan": {"rows": 5, "rejected": 0},
    }
    return str(folder / "warehouse")


@pytest.fixture(scope="module")
def bank(spark, root):
    tables = {t: open_table(spark, root, t) for t in ["branch", "credit", "customer", "loan"]}
    return tables["credit"], tables["customer"], tables["branch"], tables["loan"]


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_branch(bank):
    found = bank[2].orderBy("BRANCH_CODE").select(
        "BRANCH_CODE", "BRANCH_ZIP", "BRANCH_PHONE", F.col("LAST_UPDATED").cast("string")
    )
    moment = "2021-09-05 12:15:30"
    assert rows(found) == [
        (1, "40217", "(907)555-1234", moment),
        (2, "03068", "(907)555-8", moment),
        (3, "00000", None, moment),
    ]


def test_customer(bank):
    found = bank[1].orderBy("SSN").select(
        "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "FULL_STREET_ADDRESS", "CUST_ZIP", "CUST_PHONE"
    )
    assert rows(found) == [
        ("Mary-Jane", "ann", "O'Brien", "Main St, 4", "03068", "(202)555-0"),
        ("José", None, "De La Cruz", "Main St, 12", "03068", "(202)555-0147"),
        ("Amy", "b", "Stone", None, "40217", None),
        ("No", "x", "Purchases", "Main St, 1", "40217", "(202)555-0149"),
    ]


def test_credit(bank):
    found = bank[0].orderBy("TRANSACTION_ID").select("TIMEID", "txn_date", "txn_month")
    assert rows(found)[0] == ("20180203", dt.date(2018, 2, 3), "201802")
    assert rows(found)[8] == ("20180230", None, "201802")
    assert bank[0].schema["txn_month"].dataType.simpleString() == "string"
    assert bank[0].schema["TRANSACTION_VALUE"].dataType.simpleString() == "decimal(18,2)"


def test_loans_keep_their_columns(bank):
    declared = {"Application_Status", "Self_Employed", "Gender", "Married"}
    found = {r.other_fields["Application_ID"]: r for r in bank[3].collect()}
    assert set(bank[3].columns) == declared | {"other_fields"}
    for record in bank_data.LOANS:
        row = found[record["Application_ID"]]
        assert all(row[c] == record[c] for c in declared)
        assert row.other_fields == {c: record[c] for c in record.keys() - declared}


def test_joined_has_every_column_once(bank):
    credit, customer, branch, _ = bank
    facts = model.joined(credit, customer, branch)
    assert len(set(facts.columns)) == len(facts.columns)
    assert not {"CC_BRANCH_CODE", "CUST_CC_NO", "CUST_SSN", "LAST_UPDATED"} & set(facts.columns)
    assert {"CUST_LAST_UPDATED", "BRANCH_LAST_UPDATED"} <= set(facts.columns)
    assert sorted(r["TRANSACTION_ID"] for r in facts.collect()) == [1, 2, 3, 4, 5, 6, 9]


def test_transactions_by_zip_month(bank):
    credit, customer, branch, _ = bank
    for zip_code in ["03068", 3068]:
        found = reports.transactions_by_zip_month(credit, customer, branch, zip_code, 2, "2018")
        assert [(r["TIMEID"], r["TRANSACTION_ID"]) for r in found.collect()] == [
            ("20180230", 9), ("20180228", 4), ("20180214", 2), ("20180214", 3), ("20180203", 1),
        ]
    assert found.columns == reports.ZIP_MONTH_COLUMNS


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_type_totals(bank, limit):
    credit, customer, branch, _ = bank
    found = reports.type_totals(credit, customer, branch, max_broadcast_bytes=limit)
    assert rows(found) == [("Healthcare", 3, 46.05), ("Gas", 2, 20.21), ("Bills", 1, 0.1)]
    one = reports.type_totals(credit, customer, branch, "Gas", max_broadcast_bytes=limit)
    assert rows(one) == [("Gas", 2, 20.21)]
    none = reports.type_totals(credit, customer, branch, "Toys", max_broadcast_bytes=limit)
    assert rows(none) == []


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_branch_state_totals(bank, limit):
    credit, customer, branch, _ = bank
    found = reports.branch_state_totals(credit, customer, branch, max_broadcast_bytes=limit)
    assert rows(found) == [("OR", 3, 40.6), ("VT", 3, 25.76)]
    one = reports.branch_state_totals(credit, customer, branch, "VT", max_broadcast_bytes=limit)
    assert rows(one) == [("VT", 3, 25.76)]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_repeated_dimension_keys_multiply_as_in_the_join(bank, limit):
    credit, customer, branch, _ = bank
    twice = customer.unionByName(customer)
    found = reports.type_totals(credit, twice, branch, max_broadcast_bytes=limit)
    assert rows(found) == [("Healthcare", 6, 92.1), ("Gas", 4, 40.42), ("Bills", 2, 0.2)]


def test_account_details(bank):
    found = reports.account_details(bank[1], "123456002")
    assert found.columns == reports.ACCOUNT_COLUMNS
    assert rows(found) == [(
        "4000000000000002", "José", "De La Cruz", None, "(202)555-0147", "someone@example.com",
        "Main St, 12", "Lake", "OR", "03068",
    )]


def test_monthly_bill(bank):
    credit, card = bank[0], 4000000000000001
    lines = reports.monthly_bill_lines(credit, card, "2", 2018)
    assert [r["TRANSACTION_ID"] for r in lines.collect()] == [1, 2, 3]
    assert rows(reports.monthly_bill_total(credit, card, 2, 2018)) == [(30.4,)]
    assert rows(reports.monthly_bill_total(credit, card, 3, 2018)) == [(None,)]
    bills = {(r[0][-1], r[1]): (r[2], r[3]) for r in rows(reports.monthly_bills(credit))}
    assert bills == {
        ("1", "201802"): (3, 30.4), ("2", "201802"): (2, 30.41), ("2", "201810"): (0, None),
        ("3", "201811"): (1, 5.55), ("9", "201811"): (1, 100.0), ("1", "201812"): (1, 0.01),
    }


def test_transactions_between_dates(bank):
    credit, card = bank[0], "4000000000000002"
    found = reports.transactions_between_dates(credit, card, "2018-2-28", "10/01/2018")
    assert [r["TRANSACTION_ID"] for r in found.collect()] == [4, 9, 5]
    back = reports.transactions_between_dates(
        credit, card, dt.date(2018, 2, 28), "2018/10/1", ascending=False
    )
    assert [r["TRANSACTION_ID"] for r in back.collect()] == [5, 9, 4]
    with pytest.raises(ValueError):
        reports.transactions_between_dates(credit, card, "28.2.2018", "2018-10-01")


def test_type_counts_and_shares(bank):
    counts = rankings.type_counts(bank[0])
    assert rows(counts) == [("Healthcare", 5), ("Gas", 2), ("Bills", 1)]
    assert rows(rankings.with_share(counts, "total_number")) == [
        ("Healthcare", 5, 62.5), ("Gas", 2, 25.0), ("Bills", 1, 12.5)
    ]


def test_state_customer_counts(bank):
    assert rows(rankings.state_customer_counts(bank[1])) == [("OR", 2), ("VT", 1), (None, 0)]


def test_top_customers(bank):
    assert rows(rankings.top_customers(bank[0], 3)) == [
        ("XXX-XX-9999", 100.0), ("XXX-XX-6001", 30.41), ("XXX-XX-6002", 30.41),
    ]


def test_top_customer_breakdown(bank):
    known = bank[0].filter("CUST_SSN <> 999999999")
    assert rows(rankings.top_customer_breakdown(known)) == [
        ("Gas", 20.2, 66.4), ("Healthcare", 10.11, 33.2), ("Bills", 0.1, 0.3)
    ]


def test_top_months(bank):
    assert rows(rankings.top_months(bank[0], 2)) == [("02/2018", 5), ("11/2018", 2)]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_top_branches_for_type(bank, limit):
    credit, customer, branch, _ = bank
    found = rankings.top_branches_for_type(credit, customer, branch, max_broadcast_bytes=limit)
    assert rows(found) == [(1, 40.5), (2, 5.55)]
    first = rankings.top_branches_for_type(
        credit, customer, branch, n=1, max_broadcast_bytes=limit
    )
    assert rows(first) == [(1, 40.5)]


def test_status_percentages(bank):
    loan = bank[3]
    found = rows(loans.status_percentages(loan, loans.self_employed()))
    assert sorted(found) == [("Approved", 2, 66.67), ("Not Approved", 1, 33.33)]
    found = rows(loans.status_percentages(loan, loans.married_men()))
    assert sorted(found) == [("Approved", 1, 50.0), ("Not Approved", 1, 50.0)]


def test_status_percentages_count_applications_without_status(spark):
    loan = spark.createDataFrame(
        [("Y", "Yes"), (None, "Yes"), ("N", "No")], "Application_Status string, Self_Employed string"
    )
    found = rows(loans.status_percentages(loan, loans.self_employed()))
    assert sorted(found, key=str) == [("Approved", 1, 50.0), (None, 0, 0.0)]


def test_domains_and_membership(spark, bank):
    credit, customer, _, _ = bank
    assert sorted(rows(lookups.domain(customer, "CUST_ZIP"))) == [("03068",), ("40217",)]
    asked = spark.createDataFrame([(1, "Gas"), (2, "Toys"), (3, None), (4, "Gas")], "i int, t string")
    known = lookups.known_keys(asked, "t", credit, "TRANSACTION_TYPE")
    unknown = lookups.unknown_keys(asked, "t", credit, "TRANSACTION_TYPE")
    assert sorted(r["i"] for r in known.collect()) == [1, 4]
    assert sorted(r["i"] for r in unknown.collect()) == [2, 3]


def test_load_again(spark, tmp_path):
    paths, root = bank_data.write_bank(tmp_path), str(tmp_path / "warehouse")
    run_etl(spark, paths, root)
    run_etl(spark, paths, root)
    assert open_table(spark, root, "credit").count() == 9
    assert open_table(spark, root, "customer").count() == 4
    counts = run_etl(spark, {"credit": paths["credit"]}, root, mode="append")
    assert counts == {"credit": {"rows": 18, "rejected": 0, "undated": 0}}
    assert open_table(spark, root, "credit").count() == 18


def test_more_columns_are_kept_when_declared(spark, tmp_path):
    records = [r | {"CHANNEL": "web"} for r in bank_data.CREDITS]
    path, root = bank_data.write_lines(tmp_path / "credit.json", records), str(tmp_path / "w")
    declared = {"credit": schemas.RAW_CREDIT + ", CHANNEL STRING"}
    run_etl(spark, {"credit": path}, root, raw_schemas=declared)
    found = open_table(spark, root, "credit", schemas.CREDIT + ", CHANNEL STRING")
    assert rows(found.groupBy("CHANNEL").count()) == [("web", 9)]
    assert "CHANNEL" not in open_table(spark, root, "credit").columns


def test_replacing_months_leaves_the_others(spark, tmp_path):
    paths, root = bank_data.write_bank(tmp_path), str(tmp_path / "warehouse")
    run_etl(spark, {"credit": paths["credit"]}, root)
    again = bank_data.write_lines(tmp_path / "again.json", bank_data.CREDITS[:1])
    run_etl(spark, {"credit": again}, root, mode="replace_partitions")
    found = open_table(spark, root, "credit").groupBy("txn_month").count()
    assert sorted(rows(found)) == [("201802", 1), ("201810", 1), ("201811", 2), ("201812", 1)]


def test_records_that_do_not_parse_are_kept_aside(spark, tmp_path):
    path = bank_data.write_lines(
        tmp_path / "credit.json", bank_data.CREDITS, ['{"YEAR": 2018, "MONTH"\n']
    )
    root = str(tmp_path / "warehouse")
    for _ in range(2):  # again: the load's own rejects are replaced
        counts = run_etl(spark, {"credit": path}, root)
        assert counts == {"credit": {"rows": 9, "rejected": 1, "undated": 0}}
    assert open_table(spark, root, "credit").count() == 9
    bad = spark.read.parquet(f"{root}/rejected/credit")
    assert [r["_corrupt_record"] for r in bad.collect()] == ['{"YEAR": 2018, "MONTH"']
    other = bank_data.write_lines(tmp_path / "more.json", bank_data.CREDITS[:1])
    counts = run_etl(spark, {"credit": other}, root, mode="replace_partitions")
    assert counts["credit"]["rejected"] == 0
    assert spark.read.parquet(f"{root}/rejected/credit").count() == 1  # those of the first load


def test_fields_that_are_not_declared_are_stored(spark, tmp_path):
    records = [r | {"EXTRA": "e", "N": 7} for r in bank_data.CREDITS]
    path, root = bank_data.write_lines(tmp_path / "c.json", records), str(tmp_path / "w")
    run_etl(spark, {"credit": path}, root)
    stored = open_table(spark, root, "credit", other_fields=True)
    assert {tuple(sorted(r.other_fields.items())) for r in stored.collect()} == {
        (("EXTRA", "e"), ("N", "7"))}
    assert "other_fields" not in open_table(spark, root, "credit").columns


def test_days_out_of_range_are_in_no_bill(spark, tmp_path):
    bad = [(2018, 123, 1), (2018, 0, 1), (2018, 13, 1), (2018, 1, 234), (18, 1, 5), (2018, 12, None)]
    records = [
        dict(bank_data.CREDITS[0], TRANSACTION_ID=n, YEAR=y, MONTH=m, DAY=d)
        for n, (y, m, d) in enumerate([*bad, (2018, 12, 5)])
    ]
    path, root = bank_data.write_lines(tmp_path / "c.json", records), str(tmp_path / "w")
    assert run_etl(spark, {"credit": path}, root) == {
        "credit": {"rows": 7, "rejected": 0, "undated": 6}}
    credit, card = open_table(spark, root, "credit"), records[0]["CREDIT_CARD_NO"]
    assert [r.TRANSACTION_ID for r in
            reports.monthly_bill_lines(credit, card, 12, 2018).collect()] == [6]
    found = reports.transactions_between_dates(credit, card, "2018-01-01", "2018-12-31")
    assert [r.TRANSACTION_ID for r in found.collect()] == [6]


def test_loans_of_broken_files_and_of_changing_types(spark, tmp_path):
    path, root = tmp_path / "loan.json", str(tmp_path / "w")
    path.write_text('[{"Gender": "Male", "inc": 100}, {"Gender"')
    assert run_etl(spark, {"loan": str(path)}, root) == {"loan": {"rows": 0, "rejected": 1}}
    for amount in (100, 100.5):
        path.write_text(json.dumps([{"Gender": "Male", "inc": amount}]))
        run_etl(spark, {"loan": str(path)}, root, mode="append")
    stored = open_table(spark, root, "loan").collect()
    assert sorted(r.other_fields["inc"] for r in stored) == ["100", "100.5"]


def test_load_into_a_catalog(spark, tmp_path):
    paths, root = bank_data.write_bank(tmp_path), str(tmp_path / "w")
    counts = run_etl(spark, paths, root, sink=catalog_sink("loaded_bank", str(tmp_path / "db")))
    try:
        assert counts["credit"] == {"rows": 9, "rejected": 0, "undated": 0}
        assert spark.table("loaded_bank.customer").count() == 4
    finally:
        spark.sql("DROP DATABASE loaded_bank CASCADE")


def test_load_into_a_database_calls_its_writer(spark, tmp_path, monkeypatch):
    calls = []
    monkeypatch.setattr("cardlake.plans.etl.write_jdbc", lambda df, url, table, properties, **o:
                        calls.append((df.columns, df.count(), url, table, properties, o)))
    paths = bank_data.write_bank(tmp_path)
    counts = run_etl(spark, {"branch": paths["branch"]}, str(tmp_path / "w"),
                     sink=jdbc_sink("jdbc:x", {"user": "u"}, connections=2))
    assert counts == {"branch": {"rows": None, "rejected": 0}}
    (columns, number, *rest), = calls
    assert number == 3 and "other_fields" in columns
    assert rest == ["jdbc:x", "branch", {"user": "u"}, {"mode": "overwrite", "connections": 2}]


def test_questions_on_a_table_without_month_column(bank):
    credit, customer, branch, _ = bank
    bare, card = credit.drop("txn_month", "txn_date"), 4000000000000001
    assert [r["TRANSACTION_ID"] for r in reports.monthly_bill_lines(
        bare, card, 2, 2018, month_col=None).collect()] == [1, 2, 3]
    assert rows(reports.monthly_bill_total(bare, card, 2, 2018, month_col=None)) == [(30.4,)]
    found = reports.transactions_between_dates(
        bare, card, "2018-2-14", "2018-12-31", month_col=None)
    assert [r["TRANSACTION_ID"] for r in found.collect()] == [2, 3, 8]
    found = reports.transactions_by_zip_month(
        bare, customer, branch, 3068, 2, 2018, month_col=None)
    assert sorted(r["TRANSACTION_ID"] for r in found.collect()) == [1, 2, 3, 4, 9]


@pytest.mark.parametrize("table", ["credit", "customer"])
@pytest.mark.parametrize("lines, rejected", [([], 0), (["{bad\n", "[worse\n"], 2)])
def test_files_without_good_records(spark, tmp_path, table, lines, rejected):
    path = bank_data.write_lines(tmp_path / "raw.json", [], lines)
    root = str(tmp_path / "warehouse")
    found = run_etl(spark, {table: path}, root)
    assert found[table] == {"rows": 0, "rejected": rejected} | (
        {"undated": 0} if table == "credit" else {})
    assert open_table(spark, root, table).count() == 0


def test_no_version(spark, tmp_path):
    with pytest.raises(ValueError):
        read_latest(spark, str(tmp_path), "customer")
