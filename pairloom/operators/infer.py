"""Batch inference: a model applied to a text column, one Arrow batch at a time.

A model plugs in as a factory. The factory runs once per task and returns a scorer,
which takes a list of prompts and returns as many texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.model_calls import OnError, Retry, call_model
from pairloom.functions.payload import GenParams, request_payload, response_payload
from pairloom.sources.tables import replace_partitions

Scorer = Callable[[list[str]], list[str]]
ScorerFactory = Callable[[GenParams], Scorer]


def lead_scorer() -> ScorerFactory:
    """The built-in model: echoes the first ``max_tokens`` space-separated tokens."""

    def factory(params: GenParams) -> Scorer:
        n = params.max_tokens
        return lambda prompts: [" ".join(p.split(" ", n)[:n]) for p in prompts]

    return factory


def refusing_scorer(factory: ScorerFactory, mark: str) -> ScorerFactory:
    """A model that cannot read prompts with ``mark`` in them, to show how failures are kept."""

    def refusing(params: GenParams) -> Scorer:
        scorer = factory(params)

        def score(prompts: list[str]) -> list[str]:
            if any(mark in p for p in prompts):
                raise ValueError(f"prompt holds {mark}")
            return scorer(prompts)

        return score

    return refusing


def make_batch_udf(
    factory: ScorerFactory,
    params: GenParams,
    on_error: OnError = "null",
    call_size: int = 64,
    retry: Retry = Retry(),
    by_length: bool = True,
) -> Callable[[Column], Column]:
    """A column function giving ``struct<text, error, attempts>`` for each prompt.

    Calls, nulls, retries and errors follow :func:`pairloom.functions.model_calls.call_model`;
    the prompts of an Arrow batch go into calls by their length. The function is marked
    nondeterministic so that the optimizer neither repeats nor moves the calls.
    """

    @F.pandas_udf("text string, error string, attempts int")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = factory(params)
        for batch in batches:
            out = call_model(scorer, [batch.tolist()], on_error, call_size, retry, by_length)
            frame = pd.DataFrame(out, columns=["text", "error", "attempts"], dtype=object)
            yield frame.astype({"attempts": "int32"})

    return score.asNondeterministic()


def batch_infer(
    df: DataFrame,
    prompt_col: str,
    factory: ScorerFactory,
    params: GenParams = GenParams(),
    out_col: str = "llm_response",
    error_col: str | None = None,
    on_error: OnError = "null",
    call_size: int = 64,
    tasks: int | None = None,
    retry: Retry = Retry(),
    by_length: bool = True,
    attempts_col: str | None = None,
) -> DataFrame:
    """Add the generated text, and with ``error_col`` the reason where there is none.

    ``retry`` says how calls that a service refuses for now are tried again; with
    ``attempts_col`` each row tells how many calls it was part of (0: a null prompt).

    A slow model wants more tasks than a scan of a few files gives: ``tasks`` spreads the
    rows evenly over that many first. Save the result (``save_table``) before using it twice:
    every action on an unsaved result calls the model again. A run that takes long or costs
    much can go through :func:`pairloom.operators.resume.infer_resumable`.
    """
    if tasks is not None:
        df = df.repartition(tasks)
    udf = make_batch_udf(factory, params, on_error, call_size, retry, by_length)
    scored = df.withColumn("_scored", udf(F.col(prompt_col)))
    outputs = {out_col: F.col("_scored.text")}
    if error_col:
        outputs[error_col] = F.col("_scored.error")
    if attempts_col:
        outputs[attempts_col] = F.col("_scored.attempts")
    return scored.withColumns(outputs).drop("_scored")


def attach_predictions(df: DataFrame, preds: DataFrame, key: str) -> DataFrame:
    """All rows of ``df`` with their predictions; null where a row has none.

    Of several predictions for one key the least counts, in the order of their columns, so no
    row of ``df`` repeats. The join strategy is left to Spark, which broadcasts ``preds`` only
    when its measured size allows.
    """
    others = [c for c in preds.columns if c != key]
    one = preds.groupBy(key).agg(F.min(F.struct(*others)).alias("_one")).select(key, "_one.*")
    return df.join(one, key, "left")


def store_payload_log(log: DataFrame, run_id: str, table: str) -> DataFrame:
    """Put the log of one run into a table, in place of what stands there for the same run."""
    return replace_partitions(log.withColumn("run_id", F.lit(run_id)), table, ["run_id"])


def payload_log(
    df: DataFrame,
    request_id: str,
    prompt_col: str,
    text_col: str,
    error_col: str,
    params: GenParams,
    model: str,
) -> DataFrame:
    """One log row per request: payload, response, status and model name.

    The status is 200 for an answer, 400 for a failure, and 204, without a response, for a
    null prompt, which is never sent.
    """
    failed, unsent = F.col(error_col).isNotNull(), F.col(prompt_col).isNull()
    answer = response_payload(F.array(F.col(text_col)))
    refusal = F.to_json(F.struct(F.col(error_col).alias("error")))
    return df.select(
        F.col(request_id).alias("request_id"),
        request_payload(F.array(F.col(prompt_col)), params).alias("request"),
        F.when(failed, refusal).when(~unsent, answer).alias("response"),
        F.when(failed, 400).when(unsent, 204).otherwise(200).cast("int").alias("status"),
        F.lit(model).alias("model"),
    )
