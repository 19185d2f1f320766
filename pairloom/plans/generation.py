"""Queries around batch inference: payloads, answers, errors, request batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import payload
from pairloom.operators import infer, requests, resume, rows
from pairloom.plans import views
from pairloom.plans.storage import fresh, saved
from pairloom.sources.tables import load_dir

BATCH_SIZE = 8
ROWS_PER_BUCKET = 64
#: Put into some prompts by their row key, to show how failures are kept.
BROKEN = "[broken]"


def request_payload_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.ift(spark, sf_dir).select(
        "row_key", payload.request_payload(F.array("prompt"), views.PARAMS).alias("request")
    )


def response_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts parsed from answers; every tenth answer is malformed from its first character on."""
    answer = payload.response_payload(F.array("llm_response"))
    received = F.when(F.col("row_key") % 10 == 0, F.concat(F.lit("]"), answer)).otherwise(answer)
    answers = views.llm_out(spark, sf_dir).select("row_key", received.alias("response"))
    return answers.select("row_key", payload.response_text(F.col("response")).alias("llm_response"))


def _batches(turns: DataFrame) -> DataFrame:
    """Requests of eight prompts; (conv_id, turn) names a row of the given table."""
    return requests.batch_requests(
        turns, "text", BATCH_SIZE, ["conv_id", "turn"], views.PARAMS, ROWS_PER_BUCKET,
        unique_key=True, n_rows=turns.count(),
    )


def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(load_dir(spark, sf_dir, "conversations.parquet")).select(
        "bucket", "batch", F.array_size("prompts").cast("bigint").alias("n_prompts"), "request"
    )


def _broken(column: str, chosen: Column) -> Column:
    return F.when(chosen, F.concat(F.lit(f"{BROKEN} "), F.col(column))).otherwise(F.col(column))


def infer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request sent as one call; some requests hold a prompt that makes them fail."""
    turns = load_dir(spark, sf_dir, "conversations.parquet")
    turns = turns.withColumn("text", _broken("text", (F.col("conv_id") % 50 == 7) & (F.col("turn") == 0)))
    scorer = infer.refusing_scorer(infer.lead_scorer(), BROKEN)
    return requests.infer_batches(_batches(turns), scorer, views.PARAMS).select("bucket", "batch", "answer", "error")


def unbatch_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch answered by the model as one document, then one row per prompt again."""
    batches = _batches(load_dir(spark, sf_dir, "conversations.parquet"))
    answered = requests.infer_batches(batches, infer.lead_scorer(), views.PARAMS)
    return requests.unbatch_responses(answered.select("keys", "answer"), "answer", "keys")


def batch_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inference over the evaluation side, run once into a table."""
    return saved(views.llm_out(spark, sf_dir), "llm_out", sf_dir)


def _partly_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inference in which one prompt in fifty cannot be read."""
    prompt = _broken("prompt", F.col("row_key") % 50 == 7)
    pairs = views.ift(spark, sf_dir).select("row_key", prompt.alias("prompt"))
    scorer = infer.refusing_scorer(infer.lead_scorer(), BROKEN)
    return infer.batch_infer(pairs, "prompt", scorer, views.PARAMS, error_col="error")


def resumed_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inference in two runs over one store: the first sees every other row, the second all.

    ``run`` tells which run asked for a row: the second calls the model for the rest alone.
    """
    _, folder = fresh(spark, sf_dir, "answers")
    pairs = views.ift(spark, sf_dir).select("row_key", "prompt")
    for rows_seen in (pairs.where(F.col("row_key") % 2 == 0), pairs):
        answers = resume.infer_resumable(
            rows_seen, "prompt", ["row_key"], infer.lead_scorer(), folder, views.PARAMS, run_col="run"
        )
    return answers.select("row_key", "llm_response", "run")


def infer_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partly_broken(spark, sf_dir).select("row_key", "llm_response", "error")


def infer_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = rows.sample_row(views.ift(spark, sf_dir).select("row_key", "prompt"), "row_key")
    return infer.batch_infer(one, "prompt", infer.lead_scorer(), views.PARAMS)


def payload_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = infer.payload_log(
        _partly_broken(spark, sf_dir), "row_key", "prompt", "llm_response", "error", views.PARAMS, "lead"
    )
    table, _ = fresh(spark, sf_dir, "payload_log")
    infer.store_payload_log(log.limit(3), "run-1", table)  # a first try that was cut short
    return infer.store_payload_log(log, "run-1", table).drop("run_id")


def attach_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles for the first two evaluation rows only; the other rows stay, with null."""
    eval_side = views.split_blogs(spark, sf_dir).where(F.col("split") == "eval")
    first = rows.head_k(eval_side.select("row_key", "text"), 2, "row_key")
    preds = infer.batch_infer(
        first, "text", infer.lead_scorer(), views.PARAMS, out_col="generated_title"
    ).drop("text")
    frame = rows.to_eval_frame(eval_side.select("row_key", "prompt", "response"))
    return infer.attach_predictions(frame, preds, "row_key")


QUERIES = {
    "request_payload": request_payload_query,
    "response_text": response_text,
    "batch_requests": batch_requests,
    "infer_batches": infer_batches,
    "unbatch_responses": unbatch_responses,
    "batch_infer": batch_infer,
    "resumed_infer": resumed_infer,
    "infer_errors": infer_errors,
    "infer_one": infer_one,
    "payload_log": payload_log,
    "attach_predictions": attach_predictions,
}
