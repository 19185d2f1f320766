"""Checks and records for handing a dataset to training."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.hashing import digest
from pairloom.functions.predicates import filled
from pairloom.functions.readability import token_count

PAIR_COLUMNS = ["prompt", "response"]


def validate_ift(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """One row of counts: rows, unfit rows, and what the two sides share.

    Raises unless both sides hold exactly a string ``prompt`` and ``response``.
    """
    for side in (train, evaluation):
        if dict(side.dtypes) != dict.fromkeys(PAIR_COLUMNS, "string"):
            raise ValueError(f"expected string columns {PAIR_COLUMNS}, found {side.dtypes}")
    return validate_split(
        train.select(*PAIR_COLUMNS, F.lit("train").alias("split")).unionByName(
            evaluation.select(*PAIR_COLUMNS, F.lit("eval").alias("split"))
        )
    )


def validate_split(pairs: DataFrame, split_col: str = "split") -> DataFrame:
    """The counts of :func:`validate_ift` from one frame with its sides, ``train`` and ``eval``.

    The frame is read once. Pairs are compared by 256-bit digest, so texts are hashed where
    they lie and never shuffled; copies combine on the map side. Other sides are left out.
    """
    for name in PAIR_COLUMNS:
        if dict(pairs.dtypes).get(name) != "string":
            raise ValueError(f"expected string columns {PAIR_COLUMNS}, found {pairs.dtypes}")
    train, held = F.col(split_col) == "train", F.col(split_col) == "eval"
    unfit = ~F.coalesce(filled("prompt") & filled("response"), F.lit(False))
    names = ["train_rows", "eval_rows", "train_unfit", "eval_unfit", "shared_pairs", "shared_prompts"]
    counts = [
        F.count_if(c).alias(n) for n, c in zip(names, (train, held, train & unfit, held & unfit))
    ]
    shared = ((F.col("train_rows") > 0) & (F.col("eval_rows") > 0)).cast("bigint")

    by_pair = [digest(F.col("prompt")).alias("_p"), digest(F.col("response")).alias("_r")]
    grouped = pairs.groupBy(*by_pair).agg(*counts).withColumn("shared_pairs", shared)
    prompts = grouped.groupBy("_p").agg(*[F.sum(c).alias(c) for c in names[:5]])
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]
    return prompts.withColumn("shared_prompts", shared).agg(*totals)


def training_profile(
    df: DataFrame,
    epochs: int,
    split_col: str = "split",
    token_counter: Callable[[Column], Column] = token_count,
    tokens_col: str | None = None,
) -> DataFrame:
    """Rows, tokens, and tokens over all epochs, per split.

    ``token_counter`` is where a model's own tokenizer goes (see ``token_count_udf``);
    ``tokens_col`` names a column of tokens counted before.
    """
    if tokens_col:
        tokens = F.col(tokens_col)
    else:
        tokens = token_counter(F.col("prompt")) + token_counter(F.col("response"))
    sums = df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(tokens).alias("n_tokens")
    )
    return sums.withColumn("total_tokens", F.col("n_tokens") * epochs)


def unpivot_record(df: DataFrame, keys: list[str]) -> DataFrame:
    """A wide row as ``(key, value)`` rows, values as text."""
    as_text = df.select(*[F.col(k).cast("string").alias(k) for k in keys])
    return as_text.unpivot([], keys, "key", "value")
