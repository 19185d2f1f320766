"""Filters, counts, deduplication and splits on hand-made rows and in other layouts."""

import pytest
from pyspark.sql import functions as F

from pairloom.operators import counts, rows, splits
from pairloom.sources.tables import from_rows, load_dir, preview

TEXTS = "id long, text string, title string"


@pytest.fixture
def texts(spark):
    return from_rows(
        spark,
        [(1, "a", "t"), (2, None, "t"), (3, "", "t"), (4, " ", "t"), (5, "a", None), (6, "a", "t")],
        TEXTS,
    )


def test_blank_text_is_kept_and_null_or_empty_dropped(texts):
    kept = rows.filter_null_or_empty(texts, ["text", "title"])
    assert sorted(r.id for r in kept.collect()) == [1, 4, 6]


def test_filter_report(texts):
    report = rows.filter_report(texts, ["text", "title"])
    assert report.first().asDict() == {"rows_in": 6, "rows_dropped": 3, "rows_kept": 3}


def test_filter_report_of_no_rows(texts):
    report = rows.filter_report(texts.where("id < 0"), ["text", "title"])
    assert report.first().asDict() == {"rows_in": 0, "rows_dropped": 0, "rows_kept": 0}


def test_dedup_takes_nulls_as_equal(spark):
    df = from_rows(spark, [(1, None, "x"), (2, None, "x"), (3, "y", "x")], TEXTS)
    assert rows.dedup(df, ["text", "title"]).count() == 2
    first = rows.dedup(df, ["text", "title"], order_by="id")
    assert sorted(r.id for r in first.collect()) == [1, 3]


def test_dedup_keeps_the_whole_first_row(spark):
    df = from_rows(
        spark, [("k", 2, "b"), ("k", 1, "a"), ("j", None, "c")], "key string, at long, note string"
    )
    found = rows.dedup(df, ["key"], order_by="at")
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect()), key=repr) == [("j", None, "c"), ("k", 1, "a")]


def test_column_counts(texts):
    found = {r.column_name: r.n_values for r in counts.column_counts(texts).collect()}
    assert found == {"id": 6, "text": 5, "title": 5}


def test_first_rows(texts):
    assert [r.id for r in rows.head_k(texts, 2, "id").collect()] == [1, 2]
    assert rows.sample_row(texts, "id").first().id == 1
    assert preview(texts, 3).count() == 3


@pytest.mark.parametrize("parts", [1, 7])
def test_dedup_and_hash_split_ignore_the_layout(spark, parts):
    docs = load_dir(spark, "/root/testdata/sf0.001", "documents.parquet").select("doc_id", "text")
    plain = splits.hash_split(rows.dedup(docs, ["text"], "doc_id"), {"a": 1, "b": 1, "c": 2}, 7, ["text"])
    moved = rows.dedup(docs.repartition(parts), ["text"], "doc_id")
    moved = splits.hash_split(moved, {"a": 1, "b": 1, "c": 2}, 7, ["text"])
    assert plain.exceptAll(moved).count() == 0 == moved.exceptAll(plain).count()
    assert {r.split for r in plain.select("split").distinct().collect()} == {"a", "b", "c"}


def test_hash_split_shares(spark):
    df = spark.range(20_000)
    sizes = {
        r.split: r.n_rows
        for r in counts.split_counts(splits.hash_split(df, {"train": 0.9, "eval": 0.1}, 42, ["id"])).collect()
    }
    assert abs(sizes["eval"] - 2000) < 200


def test_a_tiny_side_is_not_empty(spark):
    found = splits.hash_split(spark.range(0, 2_000_000, 1, 8), {"train": 1, "eval": 1e-5}, 42, ["id"])
    assert 3 <= found.where("split = 'eval'").count() <= 60


def test_random_split_shares_and_seed(spark):
    df = spark.range(0, 20_000, 1, 4)
    first, again = (splits.random_split(df, [0.9, 0.1], seed=5)[1].collect() for _ in range(2))
    assert abs(len(first) - 2000) < 200 and first == again
    assert first != splits.random_split(df, [0.9, 0.1], seed=6)[1].collect()


def test_random_split_parts_are_disjoint_and_whole(spark):
    parts = splits.random_split(spark.range(1000), [0.9, 0.1])
    together = parts[0].union(parts[1])
    assert together.count() == 1000 == together.distinct().count()


def test_hot_group_of_copies_is_combined_before_the_shuffle(spark):
    """A third of all rows are one copy; no task receives more than a row per input task."""
    df = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"), "id"
    )
    found = rows.dedup(df, ["text"], "id")
    assert found.count() == 60_001
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
