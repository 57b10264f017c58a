"""Tables, catalog, and the calls made to JDBC (no database is started)."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardlake.plans.session import configure, scratch_folder, sized
from cardlake.sources import json_arrays, readers, writers


class StandIn:
    """Takes the place of a session's ``read`` or a frame's ``write`` and notes the calls."""

    def __init__(self, answer=None):
        self.read = self.write = self
        self.answer = answer
        self.calls = []
        self.options = {}

    def jdbc(self, *args, **named):
        self.calls.append((args, named))
        return self

    def first(self):
        return self.answer

    def mode(self, value):
        self.options["mode"] = value
        return self

    def option(self, key, value):
        self.options[key] = value
        return self


def test_jdbc_read_in_one_task():
    spark = StandIn()
    with pytest.warns(UserWarning, match="one task"):
        readers.read_jdbc(spark, "jdbc:x", "CREDIT", {"user": "u"})
    assert spark.calls == [
        (("jdbc:x", "CREDIT"), {"properties": {"fetchsize": "10000", "user": "u"}})]


def test_jdbc_read_in_ranges_asks_for_the_bounds():
    spark = StandIn(answer=(1, 900))
    readers.read_jdbc(spark, "jdbc:x", "CREDIT", column="TRANSACTION_ID", num_partitions=8)
    (asked, _), (args, named) = spark.calls
    assert asked[1] == (
        "(SELECT MIN(TRANSACTION_ID) AS lo, MAX(TRANSACTION_ID) AS hi FROM CREDIT) asked"
    )
    assert args == ("jdbc:x", "CREDIT")
    assert named == {
        "column": "TRANSACTION_ID", "lowerBound": "1", "upperBound": "900", "numPartitions": 8,
        "properties": {"fetchsize": "10000"},
    }


def test_jdbc_read_with_given_bounds_and_of_empty_tables():
    spark = StandIn()
    readers.read_jdbc(spark, "u", "T", column="c", num_partitions=2, bounds=(0, 10))
    assert len(spark.calls) == 1 and spark.calls[0][1]["upperBound"] == "10"
    spark = StandIn(answer=(None, None))
    readers.read_jdbc(spark, "u", "T", column="c", num_partitions=2)
    assert spark.calls[1] == (("u", "T"), {"properties": {"fetchsize": "10000"}})
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, "u", "T", column="c")


def test_jdbc_write():
    df = StandIn()
    writers.write_jdbc(df, "jdbc:x", "CREDIT", {"user": "u"}, mode="append", connections=4)
    assert df.calls == [(("jdbc:x", "CREDIT"), {"properties": {"user": "u"}})]
    assert df.options == {
        "mode": "append", "batchsize": 10_000, "truncate": True, "numPartitions": 4,
    }
    df = StandIn()
    writers.write_jdbc(df, "jdbc:x", "CREDIT")
    assert df.options["mode"] == "overwrite" and "numPartitions" not in df.options


def test_json_array_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n {"k": 1, "s": "a"},\n {"k": 2}\n]\n')
    (tmp_path / "b.json").write_text('[{"k": 3, "s": "},{"}]')
    (tmp_path / "c.json").write_text('{"k": 4, "other": {"x": [1]}}')
    (tmp_path / "d.json").write_text('[{"k": 5}, {"k": ')
    (tmp_path / "e.json").write_text(" \n")
    found = readers.read_json_array(spark, str(tmp_path), "k INT, s STRING")
    assert found.schema["k"].dataType.simpleString() == "int"
    good, bad = readers.split_corrupt(found)
    assert sorted(map(tuple, good.select("k", "s").collect())) == [
        (1, "a"), (2, None), (3, "},{"), (4, None)
    ]
    assert [r.other_fields for r in good.collect() if r.k == 4] == [{"other": '{"x":[1]}'}]
    assert [r["_corrupt_record"] for r in bad.collect()] == ['[{"k": 5}, {"k": ']


def test_which_records_are_bad_does_not_depend_on_the_columns(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"a": 1, "y": 2018}\n{"a": 2, "y": "bad"}\n{"a": 3\n\n7\nnull\n')
    good, bad = readers.split_corrupt(
        readers.read_json_lines(spark, str(path), "a BIGINT, y INT"))
    assert (good.count(), bad.count()) == (1, 4)
    assert [r.a for r in good.select("a").collect()] == [1]
    assert len(bad.select("_corrupt_record").collect()) == 4 == len(bad.select("a").collect())


def test_fields_that_are_not_declared_are_kept(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"a": 1, "EXTRA": "x", "n": 2.5}\n{"a": 2}\n')
    rows = readers.read_json_lines(spark, str(path), "a BIGINT").collect()
    assert [r.other_fields for r in rows] == [{"EXTRA": "x", "n": "2.5"}, None]


def test_a_card_lies_in_one_file_or_two(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("c0000")).otherwise(
            F.format_string("c%04d", F.col("id") % 1000)).alias("card"),
        F.col("id").alias("txn"), F.lit("201801").alias("m"))
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_table(rows, path, ["m"], ["card", "txn"], cluster_by=["card", "txn"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = readers.read_table(spark, path).withColumn("file", F.input_file_name())
    files = {r.card: r.n for r in stored.groupBy("card").agg(
        F.countDistinct("file").alias("n")).collect()}
    assert stored.select("file").distinct().count() >= 6
    assert max(n for c, n in files.items() if c != "c0000") <= 2
    assert files["c0000"] >= 2  # the hot card is cut


def test_json_lines_read_numbers_as_declared(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"z": 3068, "v": 10.1}\n{"z": "03068", "v": 3}\n{"z": null}\n')
    found = readers.read_json_lines(spark, str(path), "z STRING, v DECIMAL(18,2)")
    assert [(r["z"], str(r["v"])) for r in found.collect()] == [
        ("3068", "10.10"), ("03068", "3.00"), (None, "None")
    ]


def test_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "201801").otherwise("201802").alias("m")
    )
    for _ in range(2):
        writers.write_table(df, path, ["m"], ["id"])
    back = readers.read_table(spark, path, "id BIGINT, m STRING")
    assert back.count() == 1000
    files = [f.rsplit("/", 2)[1] for f in back.inputFiles()]
    assert sorted(files) == ["m=201801", "m=201802"]
    writers.write_table(df, path, ["m"], mode="append")
    assert readers.read_table(spark, path).count() == 2000


def test_catalog_table(spark, tmp_path):
    for _ in range(2):
        writers.ensure_database(spark, "bank_db", str(tmp_path / "it's"))
    for _ in range(2):
        writers.save_as_table(spark.range(5).withColumn("m", F.lit("x")), "bank_db.t", ["m"])
    assert spark.table("bank_db.t").count() == 5


def test_results_are_kept_whole(spark, tmp_path):
    writers.write_result(spark.range(100), str(tmp_path / "r"))
    assert readers.read_table(spark, str(tmp_path / "r")).count() == 100


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first.startswith(shared + "/") and first != second


def test_settings_follow_the_size_of_the_input():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert sized(1 << 30) == {key: "200"}
    assert sized(1 << 40) == {key: "2048"}
    assert sized(200 << 40, max_partitions=30_000) == {
        key: "30000", "spark.sql.files.maxPartitionBytes": "512m"}
    assert sized(100 << 40)[key] == "200000"

    class Builder(dict):
        def config(self, key, value):
            self[key] = value
            return self

    plain, load = configure(Builder()), configure(Builder(), load=True, input_bytes=1 << 40)
    assert plain["spark.sql.adaptive.skewJoin.enabled"] == "true" and key not in plain
    assert load[key] == "2048"
    assert load["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "512m"


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "spark://host:7077"}.get(key, default)

    with pytest.raises(ValueError):
        scratch_folder(Cluster())


def test_each_text_is_parsed_once(spark, tmp_path, capsys):
    path = tmp_path / "a.json"
    path.write_text('{"a": 1}\n')
    good, bad = readers.split_corrupt(
        readers.read_json_lines(spark, str(path), "a BIGINT, b STRING, c INT"))
    for asked in (good, bad, good.filter("a = 1"), good.filter("b = 'x'").select("c")):
        asked.explain("extended")
        optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Phys")[0]
        assert optimized.count("parseJson") == 1


def test_values_that_do_not_fit_their_type(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text("\n".join([
        '{"n": 1, "d": 1.234, "t": "x"}', '{"n": "2", "d": "3.5", "t": 7}', '{"n": 2.5}', '{"n": 3.0}',
        '{"n": 99999999999999999999}', '{"d": "x"}', '{"t": {"k": [1, "}"]}}', '{"n": null, "t": null}',
        '{"n": 1, "n": 2}', '[1]', '"text"', '{}', '{"t": ""}', '{"it\'s": 1.50, "n": 4}',
    ]))
    found = readers.read_json_lines(spark, str(path), "n INT, d DECIMAL(18,2), t STRING")
    good, bad = readers.split_corrupt(found)
    assert [tuple(map(str, r)) for r in good.collect()] == [
        ("1", "1.23", "x", "None"), ("2", "3.50", "7", "None"), ("3", "None", "None", "None"),
        ("None", "None", '{"k":[1,"}"]}', "None"), ("None",) * 4, ("None",) * 4,
        ("None", "None", "", "None"), ("4", "None", "None", "{\"it's\": '1.5'}")]
    assert [r["_corrupt_record"] for r in bad.collect()] == [
        '{"n": 2.5}', '{"n": 99999999999999999999}', '{"d": "x"}', '{"n": 1, "n": 2}', '[1]', '"text"']


def test_nested_and_oddly_named_fields(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"a b": {"x": 1}, "c.d": [1, 2], "it\'s": "y", "e": "2018-04-18T16:51:47.000-04:00"}\n')
    found = readers.read_json_lines(
        spark, str(path), "`a b` STRUCT<x: INT>, `c.d` ARRAY<INT>, `it's` STRING, e TIMESTAMP")
    row = found.select(F.col("`a b`.x"), F.col("`c.d`"), F.col("`it's`"), F.unix_timestamp("e")).first()
    assert tuple(row) == (1, [1, 2], "y", 1524084707)


def _element(rng, n):
    """A record with nested values, braces and quotes in strings, and some length."""
    text = "".join(rng.choices('ab{}[]",:\\\\ \\n\u00e9', k=rng.randrange(40)))
    return {"k": n, "s": text, "o": {"x": [1, {"y": text}], "z": {}}, "e": []}


def _split_anywhere(text, size):
    """What the tasks make of a text that is cut into parts of ``size`` bytes."""
    raw, rows, at = text.encode(), [], 0
    pieces = raw.split(b"}")
    for piece in pieces[:-1] if raw.endswith(b"}") else pieces:
        part = 0 if at == 0 else (at - 1) // size * size
        rows.append(("f", part, piece.decode(), len(raw)))
        at += len(piece) + 1
    names = ["path", "part", "value", "file_size"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
    begins = json_arrays._begins(next(json_arrays._changes(iter([batch]))).to_pylist())
    found = [r for b in json_arrays._cut(begins)(iter([batch])) for r in b.to_pylist()]
    open_ = {}
    for r in found:
        if not r["whole"]:
            open_.setdefault(r["part"], []).append((r["place"], r["value"]))
    return [r["value"] for r in found if r["whole"]] + [
        "".join(v for _, v in sorted(o)) for o in open_.values()]


@pytest.mark.parametrize("indent", [None, 2])
def test_records_are_whole_wherever_a_file_is_cut(indent):
    rng = random.Random(4)
    records = [_element(rng, n) for n in range(60)] + [{"k": 60, "s": "long " * 500}]
    text = " " + json.dumps(records, indent=indent, ensure_ascii=False) + "\n"
    for size in (*range(20, 200, 7), 1000, 10**6):
        found = sorted((json.loads(e) for e in _split_anywhere(text, size)), key=lambda r: r["k"])
        assert found == records


def test_an_array_is_cut_between_tasks(spark, tmp_path):
    rng, split = random.Random(9), 400
    records = [_element(rng, n) for n in range(24)] + [{"k": 24, "s": "long " * 500}]
    for name, part in (("a", records[:16]), ("b", records[16:])):
        (tmp_path / f"{name}.json").write_text(
            " " + json.dumps(part, ensure_ascii=False) + "\n")
    (tmp_path / "empty.json").write_text("[ ]")
    (tmp_path / "one.json").write_text('{"k": 25}')
    old = {k: spark.conf.get(k) for k in (
        "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in old:
            spark.conf.set(key, split)
        found = readers.read_json_array(spark, str(tmp_path), "k INT, s STRING, o STRING", 2)
        whole = found.collect()
        assert [r["_corrupt_record"] for r in whole] == [None] * 26
        rows = {r.k: r for r in whole}
        pieces = json_arrays._pieces(spark, [str(tmp_path / "a.json")])
        tasks = pieces.select("part").distinct().count()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert sorted(rows) == list(range(26))
    assert all(rows[r["k"]].s == r["s"] for r in records)
    assert all(json.loads(rows[r["k"]].o) == r["o"] for r in records[:24])
    assert tasks > 3


def test_broken_arrays_show_what_is_broken(spark, tmp_path):
    texts = {
        "a": '[{"k": 1}, {"k": ', "b": '[{"k": 2}, 7, "x", {"k": 3}]', "c": '[{"k": 4} {"k": 5}',
        "d": "[", "e": '[{"k": 6}]]', "f": '[{"k": "}',
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    for size in ("9",):
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = readers.read_json_array(spark, str(tmp_path), "k INT", 1).collect()
            found = sorted(r.k for r in rows if r["_corrupt_record"] is None)
            left = sorted(r["_corrupt_record"] for r in rows if r["_corrupt_record"] is not None)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert found == [1, 2, 3, 4, 5, 6]
        assert left == ['7, "x"', '{"k": ', '{"k": "}']


def test_declared_fields_are_taken_out_together(spark, tmp_path):
    path = tmp_path / "a.json"
    lines = ['{"a": 1, "s": "x"}', '{ "s":"y" , "a":"2"}', '{}', '{"a": null}', '{"a": 2.5}', '{"a": 2.0}',
             '{"a": 1, "t": [1]}', '{"a": "x", "t": 1}', '{"a": 1, "a": 1}', '{"a": 1', '7', '{"s": {"q": 1}}']
    path.write_text("\n".join(lines) + "\n")
    read = readers.read_json_lines(spark, str(path), "a INT, s STRING")
    assert [tuple(r) for r in read.collect()] == [
        (1, "x", None, None), (2, "y", None, None), (None, None, None, None), (None, None, None, None),
        (2, None, None, lines[4]), (2, None, None, None), (1, None, {"t": "[1]"}, None),
        (None, None, {"t": "1"}, lines[7]), (None, None, None, lines[8]), (None, None, None, lines[9]),
        (None, None, None, lines[10]), (None, '{"q":1}', None, None)]
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1  # the declared fields, once for all steps behind


def test_pieces_of_a_written_table_do_not_follow_the_shuffle_partitions(spark, tmp_path):
    keys = ["spark.sql.shuffle.partitions", writers._INITIAL, writers._READ, writers._MERGED]
    before = {key: spark.conf.get(key, None) for key in keys}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        rows = spark.range(600_000).select(F.xxhash64("id").alias("k"), F.lit("m").alias("m"))
        writers.write_table(rows, str(tmp_path / "t"), ["m"], ["k"], cluster_by=["k"])
        after = {key: spark.conf.get(key, None) for key in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before["spark.sql.shuffle.partitions"])
    assert after | {keys[0]: None, keys[2]: None} == before | {keys[0]: None, keys[2]: None}
    assert spark.conf.get(keys[2]) == after[keys[2]]
    stored = readers.read_table(spark, str(tmp_path / "t"))
    assert len(stored.inputFiles()) >= 2 and stored.count() == 600_000
