"""Splits with exact sizes that do not depend on how rows are laid out."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.hashing import stable_hash

#: Slots of a hash (15 hex digits), and into how many steps a round of counts cuts an interval.
SLOTS = 1 << 60
STEPS = 1 << 15


def _row_values(df: DataFrame) -> Column:
    """All columns of a row as one text, for a hash that tells any two different rows apart."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def place_of_rank(slots: DataFrame, col: str, rank: int) -> tuple[int, int, int]:
    """``(value, below, equal)``: the value in ``col`` that holds the 1-based ``rank``.

    ``below`` rows lie under it and ``equal`` rows have it. Values are 0 to 2^60 - 1. Rounds of
    counts over equal steps close in on it: nothing is sorted, a round is one aggregation with
    partial sums in every task, and the driver sees a row per step, 2^15 at most. Where the
    rank ends a step, rows up to there are known and no further round is needed; ``value`` is then
    the last one of that step and ``equal`` 0.
    """
    low, width, below = 0, SLOTS, 0
    while True:
        step = max(1, -(-width // STEPS))
        inside = slots.where((F.col(col) >= low) & (F.col(col) < low + width))
        counts = inside.groupBy(F.floor((F.col(col) - low) / step).cast("long").alias("k")).count().collect()
        for k, n in sorted((r["k"], r["count"]) for r in counts):
            if below + n >= rank:
                break
            below += n
        start = low + k * step
        if step == 1:
            return start, below, n
        if below + n == rank:
            return start + step - 1, rank, 0
        low, width = start, min(step, low + width - start)


def exact_split(
    df: DataFrame,
    weights: dict[str, float],
    seed: int,
    keys: Sequence[str] | None = None,
    out_col: str = "split",
) -> DataFrame:
    """Name each row's side so that sides have exactly their shares of the rows.

    The first side has ``round(n * share)`` rows, the first two together ``round(n * both shares)``
    and so on. Rows are told apart by a seeded hash of ``keys`` (all columns), so the same rows
    fall on the same sides however they are laid out, and again after a retry. Rows with equal
    keys are told apart by their other columns; of rows that are equal in everything, the
    number that a side lacks is taken, whichever they are. Nothing is sorted or shuffled but
    counts, and no task holds a key's rows.

    Runs at once: a few passes that count hashes. Save ``df`` first where it is costly.
    """
    _check_names(df, out_col)
    total = sum(weights.values())
    names = list(weights)
    hashed = df.withColumns({
        "_slot": stable_hash(seed, [F.col(f"`{k}`") for k in keys] if keys else [_row_values(df)], digits=15),
        "_tie": stable_hash(seed + 1, [_row_values(df)], digits=15),
    })
    slots = hashed.select("_slot", "_tie")
    n_rows = slots.count()
    side, copies = F.lit(names[-1]), []
    for name, share in reversed(list(zip(names, accumulate(weights.values())))[:-1]):
        rank = round(n_rows * share / total)
        if not rank:
            continue
        if rank >= n_rows:
            side = F.lit(name)
            continue
        value, below, equal = place_of_rank(slots, "_slot", rank)
        first = F.col("_slot") <= value
        if equal and below + equal > rank:
            # The last value is shared by rows of both sides.
            tied = slots.where(F.col("_slot") == value)
            tie, under, same = place_of_rank(tied, "_tie", rank - below)
            first = (F.col("_slot") < value) | ((F.col("_slot") == value) & (F.col("_tie") <= tie))
            if same and under + same > rank - below:
                copies.append((name, value, tie, rank - below - under))
        side = F.when(first, name).otherwise(side)
    placed = hashed.withColumn(out_col, side)
    if copies:
        placed = _share_copies(placed, copies, names, out_col)
    return placed.drop("_slot", "_tie")


def _share_copies(placed: DataFrame, copies: list[tuple[str, int, int, int]], names: list[str], out_col: str) -> DataFrame:
    """Deal equal rows at a border: one of them stands for all, repeated for each side.

    ``copies`` has, from the last border to the first, how many of its equal rows lie before it.
    """
    at_border = F.lit(False)
    parts = []
    for value, tie in {(v, t) for _, v, t, _ in copies}:
        here = (F.col("_slot") == value) & (F.col("_tie") == tie)
        at_border = at_border | here
        before = {name: n for name, v, t, n in copies if (v, t) == (value, tie)}
        one = placed.where(here).drop(out_col).groupBy(*[c for c in placed.columns if c != out_col]).count()
        # How many of the copies lie before the end of each side, in order.
        lowest = min(map(names.index, before))
        ends, last = [], F.lit(0).cast("long")
        for i, name in enumerate(names):
            if name in before:
                last = F.lit(before[name]).cast("long")
            elif i > max(map(names.index, before)):
                last = F.col("count")
            ends.append(last if i >= lowest else F.lit(0).cast("long"))
        start = F.lit(0).cast("long")
        for name, end in zip(names, ends):
            side = one.withColumn("_n", end - start).where("_n > 0")
            parts.append(
                side.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
                .withColumn(out_col, F.lit(name)).select(*placed.columns)
            )
            start = end
    rest = placed.where(~at_border)
    for part in parts:
        rest = rest.unionByName(part)
    return rest


def _check_names(df: DataFrame, out_col: str) -> None:
    taken = {"_slot", "_tie", "_n", "_copy", "count"} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"columns {sorted(taken)} clash with those of the split")
