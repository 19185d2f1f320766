"""Train and evaluation splits."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.hashing import stable_hash
from pairloom.operators.exact_split import exact_split
from pairloom.sources.tables import save_table

#: Slots of the hash: 15 hex digits.
RESOLUTION = 1 << 60


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """One frame per weight, with exactly its share of the rows.

    Sides are those of :func:`pairloom.operators.exact_split.exact_split` over all columns: the
    same rows for any layout, without a sort. Each side runs ``df`` again, so it must give the
    same rows every time; save it first if it is costly or holds arbitrary choices.
    """
    names = [str(i) for i in range(len(weights))]
    placed = exact_split(df, dict(zip(names, weights)), seed, out_col="_side")
    return [placed.where(F.col("_side") == name).drop("_side") for name in names]


def hash_split(
    df: DataFrame,
    weights: dict[str, float],
    seed: int,
    keys: list[str],
    out_col: str = "split",
) -> DataFrame:
    """Name each row's side by its own keys and the seed alone: no shuffle, no sort.

    Rows with equal keys fall on the same side. Weights are shares of their sum, held
    to one part in 2^60, so a side may be as small as a user likes.
    """
    total = sum(weights.values())
    bounds = [round(RESOLUTION * w / total) for w in accumulate(weights.values())]
    slot = stable_hash(seed, [F.col(k) for k in keys], digits=15)
    *named, last = list(weights)
    side = F.lit(last)
    for name, bound in reversed(list(zip(named, bounds))):
        side = F.when(F.col("_slot") < bound, name).otherwise(side)
    # The slot is a column of its own, so that several sides hash a row only once.
    return df.withColumn("_slot", slot).withColumn(out_col, side).drop("_slot")


def save_splits(df: DataFrame, table: str, split_col: str = "split") -> DataFrame:
    """Write all sides in one job, one partition each, and return the stored table.

    A filter on the split then reads its side's files only, and what came before the
    split runs once, not once per side.
    """
    return save_table(df, table, partition_by=[split_col])
