"""Replacing tables and parts of them, and broken lines of JSON files."""

import json
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from pairloom.operators import evaluate as ev
from pairloom.operators import infer
from pairloom.sources import jsonl, tables


@pytest.fixture
def db(spark, tmp_path):
    tables.ensure_namespace(spark, "safe_test", str(tmp_path / "db"), use=False)
    yield "safe_test"
    spark.sql("DROP DATABASE safe_test CASCADE")


def ids(df):
    return sorted(r[0] for r in df.collect())


def failing(df):
    return df.withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))


def folders(tmp_path):
    return [p.name for p in (tmp_path / "db").iterdir()]


@pytest.mark.parametrize("how", [{}, {"partition_by": ["side"]}])
def test_a_failing_write_leaves_the_old_rows(spark, db, tmp_path, how):
    rows = spark.range(5).withColumn("side", F.col("id") % 2)
    tables.save_table(rows, f"{db}.t", **how)
    for broken in (failing(rows), failing(rows).withColumn("more", F.lit(1))):
        with pytest.raises(PySparkException):
            tables.save_table(broken, f"{db}.t", **how)
        assert ids(tables.load_table(spark, f"{db}.t")) == [0, 1, 2, 3, 4]
    assert len(folders(tmp_path)) == 1 and [t.name for t in spark.catalog.listTables(db)] == ["t"]


@pytest.mark.parametrize("how", [{}, {"partition_by": ["side"]}])
def test_a_table_is_replaced_from_a_read_of_itself(spark, db, tmp_path, how):
    tables.save_table(spark.range(6).withColumn("side", F.col("id") % 2), f"{db}.t", **how)
    for least in (1, 3, 4):
        held = tables.load_table(spark, f"{db}.t")
        assert ids(tables.save_table(held.where(F.col("id") >= least), f"{db}.t", **how)) == list(range(least, 6))
    assert len(folders(tmp_path)) == 1


def test_columns_and_partitions_may_change(spark, db, tmp_path):
    tables.save_table(spark.range(3), f"{db}.t")
    more = tables.save_table(tables.load_table(spark, f"{db}.t").withColumn("s", F.lit("a")), f"{db}.t")
    assert more.columns == ["id", "s"] and ids(more) == [0, 1, 2]
    parts = tables.save_table(more, f"{db}.t", partition_by=["s"])
    assert ids(parts.where("s = 'a'")) == [0, 1, 2]
    assert ids(tables.save_table(parts.drop("s"), f"{db}.t")) == [0, 1, 2]
    tables.drop_table(spark, f"{db}.t")
    assert folders(tmp_path) == [] and not spark.catalog.tableExists(f"{db}.t")


def test_files_registered_in_place_are_never_removed(spark, db, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "given"))
    tables.register_table(spark, f"{db}.t", str(tmp_path / "given"), copy=False)
    tables.save_table(spark.range(2), f"{db}.t")
    tables.register_table(spark, f"{db}.t", str(tmp_path / "given"), copy=False)
    tables.drop_table(spark, f"{db}.t")
    assert spark.read.parquet(str(tmp_path / "given")).count() == 4


def test_a_path_that_cannot_be_read_leaves_the_table(spark, db, tmp_path):
    tables.save_table(spark.range(4), f"{db}.t")
    for copy in (True, False):
        with pytest.raises(PySparkException):
            tables.register_table(spark, f"{db}.t", str(tmp_path / "nowhere"), copy=copy)
    assert tables.load_table(spark, f"{db}.t").count() == 4


def test_a_half_done_replacement_is_undone(spark, db):
    """As if the driver had died between the two renames."""
    tables.save_table(spark.range(4), f"{db}.t")
    spark.sql(f"ALTER TABLE {db}.t RENAME TO {db}.t__old_0123456789ab")
    assert tables.load_table(spark, f"{db}.t").count() == 4
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]


def test_append_still_adds(spark, db):
    tables.save_table(spark.range(2), f"{db}.t")
    assert tables.save_table(spark.range(3), f"{db}.t", mode="append").count() == 5


def test_partitions_are_replaced_by_key(spark, db):
    first = tables.from_rows(spark, [("r1", "a/b", 1), ("r1", "c", 2), ("2", "c", 3), (None, "c", 4)], "run string, part string, v int")
    for _ in range(2):
        assert tables.replace_partitions(first, f"{db}.log", ["run", "part"]).count() == 4
    again = tables.from_rows(spark, [("r1", "c", 7), ("r1", "c", 8), ("new", "c", 9)], "run string, part string, v int")
    found = tables.replace_partitions(again.select("v", "part", "run"), f"{db}.log", ["run", "part"])
    assert sorted(((r.run, r.part, r.v) for r in found.collect()), key=repr) == sorted(
        [("r1", "a/b", 1), ("r1", "c", 7), ("r1", "c", 8), ("2", "c", 3), (None, "c", 4), ("new", "c", 9)], key=repr
    )
    assert dict(found.dtypes)["run"] == "string"
    with pytest.raises(ValueError, match="columns"):
        tables.replace_partitions(first.drop("v"), f"{db}.log", ["run", "part"])


def test_a_repeated_log_leaves_one_set_of_rows(spark, db):
    def metrics(v):
        return tables.from_rows(spark, [("m", "mean", v), ("m", "p90", v)], "metric string, stat string, value double")

    for value in (1.0, 2.0):
        ev.log_metrics(metrics(value), "run-1", f"{db}.metrics", "text")
    ev.log_metrics(metrics(3.0), "run-1", f"{db}.metrics", "judges")
    for _ in range(2):
        ev.log_metrics(metrics(4.0), "run-2", f"{db}.metrics")
    found = Counter((r.run_id, r.evaluation, r.value) for r in spark.table(f"{db}.metrics").collect())
    assert found == {("run-1", "text", 2.0): 2, ("run-1", "judges", 3.0): 2, ("run-2", "m", 4.0): 2}


def test_a_repeated_payload_log_leaves_one_set_of_rows(spark, db):
    log = tables.from_rows(spark, [(1, "q", "a", 200, "m"), (2, "q", None, 400, "m")], "request_id long, request string, response string, status int, model string")
    for part in (log.limit(1), log, log):
        infer.store_payload_log(part, "run-1", f"{db}.payloads")
    found = infer.store_payload_log(log, "run-2", f"{db}.payloads")
    assert Counter(r.run_id for r in found.collect()) == {"run-1": 2, "run-2": 2}


LINES = {
    '{"prompt":"a","n":1}': None,
    ' {"prompt":"b"} ': None,
    '{"n":3,"prompt":"c","other":[1,{"x":"}"}]}': None,
    '{"prompt":"d{\\"n\\":1}","n":null}': None,
    '{"prompt":5,"n":2}': None,
    "": "blank",
    "  ": "blank",
    '{"prompt":"e", broken': "not one object",
    '{"prompt":"f"': "not one object",
    '{"prompt":"g"}{"prompt":"h"}': "not one object",
    '{"prompt":"g"},{"prompt":"h"}': "not one object",
    '{"prompt":"i"} trailing': "not one object",
    '[{"prompt":"j"}]': "not one object",
    "5": "not one object",
    "null": "not one object",
    '"text"': "not one object",
    "plain": "not one object",
    '{"prompt":"k","n":"many"}': "wrong type",
    '{"prompt":"k","n":{"a":1}}': "wrong type",
    '{"n":1}': "no prompt",
    '{"prompt":null,"n":1}': "no prompt",
    "{}": "no prompt",
}


def test_every_line_is_kept_or_rejected(spark, tmp_path):
    for name, lines in (("one", list(LINES)[::2]), ("two", list(LINES)[1::2])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
    schema = StructType([StructField("prompt", StringType()), StructField("n", IntegerType())])
    kept, rejected = jsonl.read_jsonl_checked(spark, str(tmp_path), schema, required=["prompt"])
    assert {r.line: r.reason for r in rejected.collect()} == {k: v for k, v in LINES.items() if v}
    assert sorted((r.prompt, r.n) for r in kept.where("n IS NOT NULL").collect()) == [("5", 2), ("a", 1), ("c", 3)]
    assert sorted(r.prompt for r in kept.where("n IS NULL").collect()) == ["b", 'd{"n":1}']
    assert kept.count() + rejected.count() == len(LINES)
    assert {r.file.rsplit("/", 1)[1] for r in rejected.collect()} == {"one.jsonl", "two.jsonl"}
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_good_files_read_as_before(spark, tmp_path):
    rows = [("p", None), ('q"\n', "é"), ("_corrupt", "x")]
    jsonl.write_jsonl(tables.from_rows(spark, rows, "prompt string, response string"), str(tmp_path / "out"))
    kept, rejected = jsonl.read_jsonl_checked(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(rows, key=repr) and rejected.isEmpty()
    odd = StructType([StructField("_corrupt", StringType())])
    (tmp_path / "odd.jsonl").write_text(json.dumps({"_corrupt": "v"}) + "\n")
    assert jsonl.read_jsonl_checked(spark, str(tmp_path / "odd.jsonl"), odd)[0].first()._corrupt == "v"
