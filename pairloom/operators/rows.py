"""Row filters, projections, deduplication and first-k."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.hashing import digest
from pairloom.functions.predicates import filled
from pairloom.functions.text import before_delimiter


def filter_null_or_empty(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows where every listed column is filled."""
    return df.where(reduce(and_, [filled(c) for c in cols]))


def filter_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows in, dropped and kept by :func:`filter_null_or_empty`, in one pass."""
    kept = reduce(and_, [filled(c) for c in cols])
    counts = df.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(kept).alias("rows_kept"))
    return counts.select(
        "rows_in", (F.col("rows_in") - F.col("rows_kept")).alias("rows_dropped"), "rows_kept"
    )


def select_documented_functions(df: DataFrame) -> DataFrame:
    """Functions with arguments and a numpy-style docstring; adds ``fn_def``, the signature."""
    documented = df.where(
        F.col("doc_string").isNotNull()
        & (F.col("element_type") == "function")
        & F.col("args").isNotNull()
        & (F.length("args") > 0)
        & F.col("doc_string").contains("Parameters")
    )
    return documented.withColumn("fn_def", before_delimiter(F.col("source")))


def to_eval_frame(df: DataFrame) -> DataFrame:
    """Evaluation names for the pair columns; other columns stay."""
    return df.withColumnsRenamed({"prompt": "inputs", "response": "ground_truth"})


def dedup(df: DataFrame, keys: list[str], order_by: str | None = None) -> DataFrame:
    """One row per key, nulls equal: any row, or the first by ``order_by``.

    Both forms combine on the map side, so a group of copies, however large, reaches
    the shuffle as one row per task. A single numeric column beside the keys keeps the
    aggregation hash-based; text beside the keys makes it sort-based.
    """
    if order_by is None:
        return df.dropDuplicates(keys)
    others = [c for c in df.columns if c not in keys]
    if others == [order_by]:
        return df.groupBy(*keys).agg(F.min(order_by).alias(order_by)).select(*df.columns)
    first = F.min_by(F.struct(*others), F.struct(F.col(order_by).isNull(), F.col(order_by)))
    kept = df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")
    return kept.select(*df.columns)


def dedup_rows(df: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """One row per key, nulls equal: the one with the smallest ``row_id``, which no two rows share.

    For wide rows: keys are grouped as 32-byte digests with numbers beside them, so the
    aggregation is hash-based, copies combine on the map side, and no text is in it. Then the
    kept rows are picked by a semi-join on ``row_id``, which Spark turns into a filter where
    they are few, and deals anew where one task would get too many. Reads ``df`` twice, so it
    must give the same rows each time. A null ``row_id`` loses against any other; a key that has
    only rows without id is left out.
    """
    codes = [digest(F.coalesce(F.concat(F.lit("v"), F.col(f"`{k}`").cast("string")), F.lit("n"))).alias(f"k{i}") for i, k in enumerate(keys)]
    kept = df.groupBy(*codes).agg(F.min(row_id).alias(row_id)).select(row_id)
    return df.join(kept, row_id, "left_semi").select(*df.columns)


def head_k(df: DataFrame, k: int, order_by: str | list[str]) -> DataFrame:
    """The first ``k`` rows in the given order: a top-k, never a full sort."""
    return df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)).limit(k)


def sample_row(df: DataFrame, order_by: str | list[str]) -> DataFrame:
    """One row, the same one every time."""
    return head_k(df, 1, order_by)
