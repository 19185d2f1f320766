"""Tables, directories, and JSON Lines files."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pairloom.operators.rows import select_documented_functions
from pairloom.operators.splits import save_splits
from pairloom.plans import views
from pairloom.sources import jsonl, tables
from pairloom.sources.workspace import shared_dir, workspace

PAIR = "prompt string, response string"


@pytest.fixture
def db(spark, tmp_path):
    tables.ensure_namespace(spark, "storage_test", str(tmp_path / "db"), use=False)
    yield "storage_test"
    spark.sql("DROP DATABASE storage_test CASCADE")


def lines(path):
    return [json.loads(line) for line in Path(path).read_text().splitlines()]


def test_table_round_trip_and_drop(spark, db, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    for copy in (True, False):
        for _ in range(2):
            found = tables.register_table(spark, f"{db}.t", str(tmp_path / "in"), copy=copy)
            assert found.count() == 5
    tables.drop_table(spark, f"{db}.t")
    tables.drop_table(spark, f"{db}.t")
    assert not spark.catalog.tableExists(f"{db}.t")
    assert tables.load_dir(spark, str(tmp_path), "in").count() == 5


def test_other_formats(spark, tmp_path):
    for fmt in ("orc", "json"):
        spark.range(5).write.format(fmt).save(str(tmp_path / fmt))
        assert tables.load_dir(spark, str(tmp_path) + "/", fmt, fmt).count() == 5


def test_save_replaces(spark, db):
    tables.save_table(spark.range(5), f"{db}.s")
    assert tables.save_table(spark.range(3), f"{db}.s").count() == 3
    assert tables.load_table(spark, f"{db}.s").count() == 3


def test_saved_splits_are_read_by_file(spark, db):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 90, "train").otherwise("eval"))
    evaluation = save_splits(df, f"{db}.sides").where("split = 'eval'")
    assert evaluation.count() == 10
    assert "PartitionFilters: [isnotnull(split" in evaluation._jdf.queryExecution().executedPlan().toString()


def test_selector_filters_reach_the_files(spark, db):
    tables.save_table(views.code_elements(spark, "/root/testdata/sf0.001"), f"{db}.code")
    chosen = select_documented_functions(tables.load_table(spark, f"{db}.code"))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    for part in ("IsNotNull(doc_string)", "EqualTo(element_type,function)", "StringContains(doc_string,Param"):
        assert part in plan


def test_null_fields_are_left_out_and_restored(spark, tmp_path):
    df = tables.from_rows(spark, [("p", None), ('q"\n', "é")], PAIR)
    jsonl.write_jsonl(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert '{"prompt":"p"}' in text
    found = jsonl.read_jsonl(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([("p", None), ('q"\n', "é")], key=repr)


@pytest.mark.parametrize("parts", [1, 5])
def test_single_file(spark, tmp_path, parts):
    df = spark.range(0, 100, 1, parts).select(
        F.concat(F.lit("p\r\n"), "id").alias("prompt"), F.lit("r").alias("response")
    )
    target = tmp_path / "train.jsonl"
    for _ in range(2):
        jsonl.export_single_jsonl(df, str(target))
        assert sorted(r["prompt"] for r in lines(target)) == sorted(f"p\r\n{i}" for i in range(100))
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["train.jsonl"]


def test_single_file_of_no_rows(spark, tmp_path):
    jsonl.export_single_jsonl(tables.from_rows(spark, [], PAIR), str(tmp_path / "none.jsonl"))
    assert (tmp_path / "none.jsonl").read_text() == ""


def test_one_file_of_many_parts(spark, tmp_path):
    df = spark.range(0, 50_000, 1, 40).select("id", F.repeat(F.lit("x"), 100).alias("response"))
    jsonl.export_single_jsonl(df, str(tmp_path / "big.jsonl"))
    assert sorted(r["id"] for r in lines(tmp_path / "big.jsonl")) == list(range(50_000))


def test_one_file_is_filled_by_many_tasks(spark, tmp_path, monkeypatch):
    """No task copies more than a piece, and a file that is replaced leaves no sums of its own."""

    def one_task(*_):
        raise AssertionError("one task copies everything")

    monkeypatch.setattr(jsonl, "_copy_to_one", one_task)
    monkeypatch.setattr(jsonl, "PIECE_BYTES", 1000)
    target = tmp_path / "big.jsonl"
    jsonl.export_single_jsonl(spark.range(10).coalesce(1), str(target))
    df = spark.range(0, 3000, 1, 7).select("id", F.repeat(F.lit("é"), 30).alias("response"))
    jsonl.export_single_jsonl(df, str(target))
    assert [r["id"] for r in lines(target)] == list(range(3000))
    assert sorted(r.id for r in spark.read.json(str(target)).collect()) == list(range(3000))
    assert jsonl._pieces([2500, 0, 10]) == [(0, 0, 0, 1000), (0, 1000, 1000, 1000), (0, 2000, 2000, 500), (2, 0, 2500, 10)]


def test_a_second_call_leaves_the_first_result(spark):
    """Queries that write do so under names of their own."""
    from pairloom.plans import generation, scoring, storage

    writing = [
        storage.scan_table, storage.register_table, storage.save_table, storage.save_splits, storage.jsonl_roundtrip,
        storage.export_single_jsonl, storage.table_to_jsonl, storage.namespace_ddl, generation.batch_infer,
        generation.payload_log, scoring.metric_summary, scoring.metrics_json, scoring.run_metrics,
    ]
    for query in writing:
        first, again = (query(spark, "/root/testdata/sf0.001") for _ in range(2))
        assert first.count() == again.count() > 0


def test_joining_files_checks_that_nothing_is_lost(spark, tmp_path):
    """The raw local file system's own join drops the first file."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.RawLocalFileSystem()
    fs.initialize(spark._jvm.java.net.URI("file:///"), spark._jsc.hadoopConfiguration())
    for name in "abc":
        (tmp_path / name).write_text(name * 9)
    with pytest.raises(RuntimeError, match="lost data"):
        jsonl._join_files(spark, fs, [hadoop.Path(str(tmp_path / name)) for name in "abc"])


def test_two_tables_make_two_files(spark, db, tmp_path):
    for name, n in (("train", 9), ("eval", 1)):
        tables.save_table(spark.range(n), f"{db}.{name}")
        jsonl.table_to_jsonl(spark, f"{db}.{name}", str(tmp_path / f"{name}.jsonl"))
    assert len(lines(tmp_path / "train.jsonl")) == 9
    assert len(lines(tmp_path / "eval.jsonl")) == 1


def test_export_of_the_first_rows(spark, db, tmp_path):
    tables.save_table(spark.range(20), f"{db}.many")
    jsonl.table_to_jsonl(spark, f"{db}.many", str(tmp_path / "few.jsonl"), limit=3, order_by=["id"])
    assert sorted(r["id"] for r in lines(tmp_path / "few.jsonl")) == [0, 1, 2]


def test_workspace_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    assert base is None or folder.startswith(base)
    assert workspace(spark, "a") == workspace(spark, "a") != workspace(spark, "b")
