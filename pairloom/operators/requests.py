"""Many prompts per request, and the answers put back on their rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.hashing import stable_hash
from pairloom.functions.model_calls import OnError, Retry, call_model
from pairloom.functions.payload import GenParams, request_payload, response_payload, response_texts
from pairloom.operators.infer import ScorerFactory


def batch_requests(
    df: DataFrame,
    prompt_col: str,
    batch_size: int,
    key: list[str],
    params: GenParams = GenParams(),
    rows_per_bucket: int = 1024,
    unique_key: bool = False,
    n_rows: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Requests of up to ``batch_size`` prompts: ``(bucket, batch, keys, prompts, request)``.

    Rows are hashed to buckets of about ``rows_per_bucket`` and numbered by key within
    their bucket, so nothing is ever ranked globally and the outcome does not depend on
    the layout. The number of buckets grows with the row count.

    A key that repeats cannot fill a bucket: equal rows are first counted, with map-side
    combine, and a count is cut into pieces of at most ``rows_per_bucket`` copies that
    hash to buckets of their own. Pass ``unique_key`` where the key is known to identify
    a row, which saves that first shuffle. The number of buckets needs the row count: pass
    ``n_rows`` where it is known, or ``df`` is counted on the spot (of a stored table that
    reads no rows).
    """
    rows = df.select(*key, F.col(prompt_col).alias("_prompt"))
    n_rows = df.count() if n_rows is None else n_rows
    n_buckets = max(1, math.ceil(n_rows / rows_per_bucket))
    zero = F.lit(0).cast("bigint")
    if unique_key:
        pieces = rows.withColumn("_piece", zero).withColumn("_copies", zero + 1)
    else:
        counted = rows.groupBy(*key, "_prompt").agg(F.count(F.lit(1)).alias("_copies"))
        last = F.floor((F.col("_copies") - 1) / rows_per_bucket)
        pieces = counted.withColumn("_piece", F.explode(F.sequence(zero, last)))
        left = F.col("_copies") - F.col("_piece") * rows_per_bucket
        pieces = pieces.withColumn("_copies", F.least(left, F.lit(rows_per_bucket)))
    hashed = stable_hash(seed, [*map(F.col, key), F.col("_prompt"), F.col("_piece")], digits=15)
    in_bucket = (
        Window.partitionBy("bucket")
        .orderBy(*key, "_prompt", "_piece")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = pieces.withColumn("bucket", hashed % n_buckets).withColumn(
        "_end", F.sum("_copies").over(in_bucket)
    )
    # Positions from 0 within the bucket, one row per copy again.
    numbered = placed.withColumn(
        "_pos", F.explode(F.sequence(F.col("_end") - F.col("_copies"), F.col("_end") - 1))
    )
    item = F.struct("_pos", F.struct(*key).alias("key"), "_prompt")
    batches = numbered.groupBy("bucket", F.floor(F.col("_pos") / batch_size).alias("batch")).agg(
        F.array_sort(F.collect_list(item)).alias("_items")
    )
    return batches.select(
        "bucket",
        "batch",
        F.col("_items.key").alias("keys"),
        F.col("_items._prompt").alias("prompts"),
        request_payload(F.col("_items._prompt"), params).alias("request"),
    )


def infer_batches(
    batches: DataFrame,
    factory: ScorerFactory,
    params: GenParams = GenParams(),
    prompts_col: str = "prompts",
    out_col: str = "answer",
    error_col: str = "error",
    on_error: OnError = "null",
    retry: Retry = Retry(),
) -> DataFrame:
    """Send each packed request as one call of the model; add its answer document and error.

    ``params`` are those of the requests. A call answers all prompts of its request or none: a
    failure costs that request alone, after what ``retry`` allows; its answer is null and its
    ``error`` says why. A null
    prompt in a request fails it. Requests are scored in Arrow batches, the model is loaded
    once per task, and nothing is shuffled.
    """

    @F.pandas_udf("texts array<string>, error string")
    def score(groups: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = factory(params)

        def one(requests: list) -> list[list[str]]:
            return [_whole(scorer, list(prompts)) for prompts in requests]

        for requests in groups:
            out = call_model(one, [requests.tolist()], on_error, call_size=1, retry=retry)
            texts, errors, _ = [list(c) for c in zip(*out)] if out else ([], [], [])
            yield pd.DataFrame({"texts": pd.Series(texts, dtype=object), "error": pd.Series(errors, dtype=object)})

    scored = batches.withColumn("_scored", score.asNondeterministic()(F.col(prompts_col)))
    texts = F.col("_scored.texts")
    answer = F.when(texts.isNotNull(), response_payload(texts))
    return scored.withColumns({out_col: answer, error_col: F.col("_scored.error")}).drop("_scored")


def _whole(scorer: Callable[[list[str]], list[str]], prompts: list[str]) -> list[str]:
    texts = list(scorer(prompts))
    if len(texts) != len(prompts):
        raise ValueError(f"scorer gave {len(texts)} texts for {len(prompts)} prompts")
    return texts


def unbatch_responses(
    df: DataFrame, response_col: str, keys_col: str, out_col: str = "llm_response"
) -> DataFrame:
    """One row per key of a batched response: the key's fields, its place, its text.

    Every key keeps its row; its text is null where the response is malformed or short.
    """
    texts = F.coalesce(response_texts(F.col(response_col)), F.array().cast("array<string>"))
    paired = df.select(
        F.col(keys_col).alias("key"), F.slice(texts, 1, F.array_size(keys_col)).alias("text")
    )
    # Zipped before it is exploded, so that a row carries its own text only.
    rows = paired.select(F.posexplode(F.arrays_zip("key", "text")).alias("pos", "item"))
    return rows.select(
        "item.key.*", F.col("pos").cast("bigint").alias("pos"), F.col("item.text").alias(out_col)
    )
