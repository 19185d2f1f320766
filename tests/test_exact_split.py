"""Exact splits and deduplication of whole rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.operators import exact_split as ex
from pairloom.operators import rows, splits
from pairloom.sources.tables import from_rows

THREE = {"train": 0.7, "eval": 0.2, "test": 0.1}


def sides(df, weights=THREE, keys=None, seed=1):
    return ex.exact_split(df, weights, seed, keys)


def sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 999, 40_000])
def test_sizes_are_exact(spark, n):
    found = sizes(sides(spark.range(n)))
    ends = [round(n * 0.7), round(n * 0.9), n]
    wanted = {"train": ends[0], "eval": ends[1] - ends[0], "test": n - ends[1]}
    assert found == {k: v for k, v in wanted.items() if v}


def test_the_layout_does_not_matter(spark):
    df = spark.range(5000).withColumn("text", F.md5(F.col("id").cast("string")))
    plain = {r.id: r.split for r in sides(df.coalesce(1)).collect()}
    for moved in (df.repartition(13), df.orderBy(F.desc("id")), df.repartition(3, "text")):
        assert {r.id: r.split for r in sides(moved).collect()} == plain
    assert {r.id: r.split for r in sides(df, seed=2).collect()} != plain
    assert "Sort" not in sides(df)._jdf.queryExecution().executedPlan().toString()


def test_a_key_of_a_third_of_the_rows_is_cut_by_its_other_columns(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), "id")
    found = sides(df, keys=["key"])
    assert sizes(found) == {"train": 2100, "eval": 600, "test": 300}
    plain = {r.id: r.split for r in found.collect()}
    assert {r.id: r.split for r in sides(df.repartition(7), keys=["key"]).collect()} == plain


@pytest.mark.parametrize("n_same", [10, 1000, 997])
def test_equal_rows_are_dealt_by_number(spark, n_same):
    """Rows that nothing tells apart, up to all of them, still give exact sizes."""
    same = spark.range(n_same).select(F.lit("x").alias("text"), F.lit(None).cast("int").alias("n"))
    df = same.unionByName(spark.range(1000 - n_same).select(F.col("id").cast("string").alias("text"), F.lit(1).alias("n")))
    found = sides(df)
    assert sizes(found) == {"train": 700, "eval": 200, "test": 100}
    assert Counter(r.text for r in found.collect()) == Counter(r.text for r in df.collect())
    assert found.columns == ["text", "n", "split"]


def test_odd_weights_and_empty_tables(spark):
    df = spark.range(100)
    assert sizes(sides(df, {"a": 0, "b": 3, "c": 0, "d": 1})) == {"b": 75, "d": 25}
    assert sizes(sides(df, {"all": 1})) == {"all": 100}
    assert sizes(sides(df, {"all": 1, "none": 0})) == {"all": 100}
    assert sides(df.limit(0)).isEmpty()
    with pytest.raises(ValueError, match="clash"):
        sides(df.withColumn("_tie", F.lit(1)))


def test_random_split_is_exact_and_repeatable(spark):
    df = spark.range(0, 1000, 1, 5).select("id", F.lit("t").alias("text"))
    train, held = splits.random_split(df, [0.9, 0.1], 7)
    assert (train.count(), held.count()) == (900, 100)
    assert train.unionByName(held).distinct().count() == 1000
    assert sorted(map(tuple, splits.random_split(df.repartition(3), [0.9, 0.1], 7)[1].collect())) == sorted(map(tuple, held.collect()))


def test_ranks_equal_a_sort(spark):
    values = [5, 5, 5, 7, 9, 9, (1 << 60) - 1, 0, 3, 1 << 59]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for rank in range(1, len(values) + 1):
        value, below, equal = ex.place_of_rank(df, "v", rank)
        held = sorted(values)[rank - 1]
        if equal:
            assert (value, below, equal) == (held, sum(v < held for v in values), values.count(held))
        else:
            assert below == rank and sum(v <= value for v in values) == rank


def test_whole_rows_without_copies(spark):
    data = [(5, "a", None, 1.0), (2, "a", None, 2.0), (9, None, None, 3.0), (7, None, None, 4.0), (1, "n", "v", 5.0), (3, "", "v", 6.0), (None, "a", None, 7.0)]
    df = from_rows(spark, data, "id long, text string, title string, score double")
    found = sorted(map(tuple, rows.dedup_rows(df, ["text", "title"], "id").collect()))
    assert found == [(1, "n", "v", 5.0), (2, "a", None, 2.0), (3, "", "v", 6.0), (7, None, None, 4.0)]
    plan = rows.dedup_rows(df, ["text", "title"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_a_hot_group_of_copies_stays_split(spark):
    df = spark.range(0, 30_000, 1, 6).select("id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    found = rows.dedup_rows(df, ["text"], "id")
    assert found.count() == 20_001 and found.where("text = 'same'").first().id == 0
