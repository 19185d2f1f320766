"""Exact percentiles of any number of values, without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F


def first_look(cols: Sequence[str], p: float, accuracy: int = 10_000) -> list[Column]:
    """One aggregate per column: its count, and an interval proposed around the percentile."""
    margin = 3.0 / accuracy
    around = [max(0.0, p - margin), min(1.0, p + margin)]
    return [
        F.struct(F.count(c).alias("n"), F.percentile_approx(c, around, accuracy).alias("near")).alias(f"look{i}")
        for i, c in enumerate(cols)
    ]


def usable(c: str) -> Column:
    """A score column as double, NaN as null."""
    return F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c)


@dataclass
class _Search:
    """The value of one rank: it lies in [low, high], with ``below`` values under ``low``."""

    metric: str
    rank: int
    low: float
    high: float
    below: int = 0
    outside: bool = True


def exact_percentiles(
    df: DataFrame, cols: Sequence[str], p: float, accuracy: int = 10_000, bins: int = 4096, looks: Row | None = None
) -> dict[str, float]:
    """Linear-interpolated percentile of each column that has values; nulls and NaN are ignored.

    An approximate percentile proposes an interval. Each round counts the values of ``bins``
    equal steps over it, and of all below and above, with the least and greatest value of each;
    the step that holds the wanted rank, between its own extremes, is the next interval. Every
    round parts at least two values, so the search ends at one value, however values crowd, and
    a value that repeats is only a count. The driver sees one row per column and rank, tasks at
    most ``bins + 3`` steps of each. Rows are copied only for columns still searched.

    ``looks`` is the row of :func:`first_look` where the caller has it already.
    """
    df = df.select(*[usable(c) for c in cols])
    looks = looks or df.agg(*first_look(cols, p, accuracy)).first()
    searches, ranks = [], {}
    for i, c in enumerate(cols):
        n, near = looks[f"look{i}"]
        if n:
            ranks[c] = (n - 1) * p
            searches += [_Search(c, r, *near) for r in {floor(ranks[c]), ceil(ranks[c])}]
    while open_ := [s for s in searches if s.outside or s.low < s.high]:
        for r in _steps(df, open_, bins).collect():
            s = open_[r.search]
            s.low, s.high, s.below, s.outside = r.least, r.most, r.below, False
    values = {(s.metric, s.rank): s.low for s in searches}
    return {c: _between(values[c, floor(r)], values[c, ceil(r)], r - floor(r)) for c, r in ranks.items()}


def _between(a: float, b: float, share: float) -> float:
    return a + (b - a) * share if b > a else a


def _steps(df: DataFrame, searches: list[_Search], bins: int) -> DataFrame:
    """``(search, below, least, most)``: the step that holds each search's rank."""
    metrics = sorted({s.metric for s in searches})
    score = F.col("score")
    rows = df.unpivot([], metrics, "metric", "score").where(score.isNotNull())
    bounds = [(i, s.metric, s.rank, s.low, s.high, s.below, s.outside) for i, s in enumerate(searches)]
    names = "search int, metric string, rank long, low double, high double, before long, outside boolean"
    # At most two rows per column.
    of = F.broadcast(df.sparkSession.createDataFrame(bounds, names))
    inside = (score >= F.col("low")) & (score <= F.col("high"))
    width = F.col("high") - F.col("low")
    finite = (width > 0) & (width < float("inf"))
    # Infinite ends are steps of their own, so that what lies between them has a width next.
    step = (
        F.when(score < F.col("low"), -1)
        .when(score > F.col("high"), bins + 2)
        .when(finite, F.floor((score - F.col("low")) / width * bins))
        .when(score == F.col("low"), 0)
        .when(score == F.col("high"), bins + 1)
        .when(score < 0, 1)
        .when(score == 0, 2)
        .otherwise(3)
    )
    counted = (
        rows.join(of, "metric")
        .where(F.col("outside") | inside)
        .withColumn("step", step)
        .groupBy("search", "rank", "before", "step")
        .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"), F.max("score").alias("most"))
    )
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("search").orderBy("step"))
    placed = counted.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("n"))
    return placed.where((F.col("below") <= F.col("rank")) & (F.col("upto") > F.col("rank"))).select(
        "search", "below", "least", "most"
    )
