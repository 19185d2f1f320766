"""Queries that score generations and summarise the scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.judges import PluggedMetric, correctness_model, similarity_model
from pairloom.operators import evaluate as ev
from pairloom.operators.rows import to_eval_frame
from pairloom.plans import views
from pairloom.plans.generation import attach_predictions
from pairloom.plans.storage import fresh, saved
from pairloom.sources.tables import drop_table, load_dir, save_table

JUDGES = [ev.ANSWER_SIMILARITY, ev.ANSWER_CORRECTNESS]
TEXT_SCORES = ["token_count", "flesch_kincaid_grade", "ari_grade", "toxicity"]
JUDGE_SCORES = ["answer_similarity", "answer_correctness"]
THRESHOLDS = {"toxicity": 0.5}
RUN_ID = "run-1"


def _round(col: Column) -> Column:
    return F.round(col, 6)


def _labelled(df: DataFrame, sf_dir: str) -> DataFrame:
    labels = load_dir(df.sparkSession, sf_dir, "labels.parquet")
    toxic = labels.select(F.col("doc_id").alias("row_key"), "toxic")
    return df.join(toxic, "row_key", "left")


def eval_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_eval_frame(views.llm_out(spark, sf_dir))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: _round(F.col(c)) for c in ("flesch_kincaid_grade", "ari_grade")})


def text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ev.text_metrics(views.documents(spark, sf_dir).select("doc_id", "text"), "text")
    return _rounded(scored.drop("text"))


def toxicity_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select(F.col("doc_id").alias("row_key"))
    scored = ev.toxicity(_labelled(docs, sf_dir), "toxic")
    return scored.withColumn("toxicity_ratio", _round(F.col("toxicity_ratio")))


def judge_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = ev.judge_similarity(views.llm_out(spark, sf_dir), "llm_response", "response")
    return judged.select("row_key", "answer_similarity")


def judge_correctness(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = ev.judge_correctness(views.llm_out(spark, sf_dir), "llm_response", "response")
    return judged.select("row_key", "answer_correctness")


def _scores(frame: DataFrame, sf_dir: str) -> DataFrame:
    scored = ev.evaluate(
        _labelled(frame, sf_dir), "ground_truth", "llm_response", "text", JUDGES, toxicity="toxic"
    )
    return scored.select("row_key", *TEXT_SCORES, *JUDGE_SCORES)


def evaluate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_scores(eval_frame(spark, sf_dir), sf_dir))


def evaluate_plugged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two judges outside Spark over the evaluation side, in one pass."""
    judges = [PluggedMetric("answer_similarity", similarity_model), PluggedMetric("answer_correctness", correctness_model)]
    scored = ev.evaluate(eval_frame(spark, sf_dir), "ground_truth", "llm_response", extra=judges)
    return scored.select("row_key", "answer_similarity", "answer_correctness")


def _summary(frame: DataFrame, sf_dir: str) -> DataFrame:
    """The summary of stored scores; the scores are dropped, as the summary is complete."""
    spark = frame.sparkSession
    table, _ = fresh(spark, sf_dir, "scores")
    scores = save_table(_scores(frame, sf_dir), table)
    metrics = ev.aggregate_scores(scores, [*TEXT_SCORES, *JUDGE_SCORES], thresholds=THRESHOLDS)
    drop_table(spark, table)
    return metrics.withColumn("value", _round(F.col("value")))


def metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(eval_frame(spark, sf_dir), sf_dir)


def partial_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles attached to two rows, the frame stored, and the whole of it scored and summarised."""
    frame = saved(attach_predictions(spark, sf_dir), "eval_frame", sf_dir)
    return _summary(frame.withColumnRenamed("generated_title", "llm_response"), sf_dir)


def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.metrics_json(metric_summary(spark, sf_dir))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two evaluations under one run, the text defaults and the judges alone; the first one is
    logged again, as after a retry, and stands there once."""
    table, _ = fresh(spark, sf_dir, "run_metrics")
    held, _ = fresh(spark, sf_dir, "scores")
    scores = save_table(_scores(eval_frame(spark, sf_dir), sf_dir), held)
    text = ev.aggregate_scores(scores, TEXT_SCORES, thresholds=THRESHOLDS)
    ev.log_metrics(text, RUN_ID, table, "text")
    ev.log_metrics(ev.aggregate_scores(scores, JUDGE_SCORES), RUN_ID, table, "judges")
    logged = ev.log_metrics(text, RUN_ID, table, "text")
    drop_table(spark, held)
    return logged.select("run_id", "metric", "stat", _round(F.col("value")).alias("value"))


QUERIES = {
    "eval_frame": eval_frame,
    "text_metrics": text_metrics,
    "toxicity_ratio": toxicity_ratio,
    "judge_similarity": judge_similarity,
    "judge_correctness": judge_correctness,
    "evaluate_rows": evaluate_rows,
    "evaluate_plugged": evaluate_plugged,
    "metric_summary": metric_summary,
    "partial_summary": partial_summary,
    "metrics_json": metrics_json,
    "run_metrics": run_metrics,
}
