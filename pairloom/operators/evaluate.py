"""Scores per row, their summary, and the log of a run's metrics."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.judges import PluggedMetric, correctness, plugged_scores, similarity
from pairloom.functions.readability import (
    WHITE_CHARACTERS,
    ari_grade,
    fk_grade,
    sentence_count,
    syllable_count,
    tokens,
)
from pairloom.operators.percentile import exact_percentiles, first_look, usable
from pairloom.sources.tables import replace_partitions, save_table


@dataclass(frozen=True)
class Metric:
    """A named score of ``(prediction, target)``."""

    name: str
    score: Callable[[Column, Column], Column]
    #: The score is ``struct<value, error>``, as of a judge with details.
    details: bool = False


ANSWER_SIMILARITY = Metric("answer_similarity", similarity)
ANSWER_CORRECTNESS = Metric("answer_correctness", correctness)


def given_score(name: str, col: str) -> Metric:
    """A score some model has already put in a column, such as toxicity."""
    return Metric(name, lambda pred, target: F.col(col))


def text_metrics(
    df: DataFrame, col: str, token_counter: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add ``token_count``, ``flesch_kincaid_grade`` and ``ari_grade`` of a text column.

    Each text is split and counted once: the counts are columns of their own below the
    grades, where the optimizer keeps them since several grades use them. Tokens are
    words unless ``token_counter`` counts them by a model's own tokenizer.
    """
    text = F.col(col)
    counted = df.select("*", tokens(text).alias("_tokens")).select(
        *df.columns,
        F.array_size("_tokens").cast("bigint").alias("_words"),
        F.length(reduce(lambda c, w: F.replace(c, F.lit(w), F.lit("")), WHITE_CHARACTERS, text)).alias("_characters"),
        sentence_count(text).alias("_sentences"),
        syllable_count(text).alias("_syllables"),
    )
    n, s = F.col("_words"), F.col("_sentences")
    return counted.select(
        *df.columns,
        (token_counter(text) if token_counter else n).alias("token_count"),
        fk_grade(n, s, F.col("_syllables")).alias("flesch_kincaid_grade"),
        ari_grade(F.col("_characters"), n, s).alias("ari_grade"),
    )


MODEL_TYPES = {"text": text_metrics}


def judge_similarity(
    df: DataFrame, pred: str, truth: str, judge: Callable[[Column, Column], Column] = similarity
) -> DataFrame:
    return df.withColumn("answer_similarity", judge(F.col(pred), F.col(truth)))


def judge_correctness(
    df: DataFrame, pred: str, truth: str, judge: Callable[[Column, Column], Column] = correctness
) -> DataFrame:
    return df.withColumn("answer_correctness", judge(F.col(pred), F.col(truth)))


def toxicity(df: DataFrame, score_col: str, threshold: float = 0.5) -> DataFrame:
    """Share of scored rows above the threshold, with the counts behind it."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(score_col).alias("n_scored"),
        _share_above(score_col, threshold).alias("toxicity_ratio"),
    )


def _share_above(col: str, threshold: float) -> Column:
    score = F.col(col)
    return F.avg(F.when(score > threshold, 1.0).when(score.isNotNull(), 0.0))


def evaluate(
    df: DataFrame,
    targets: str,
    predictions: str,
    model_type: str | None = None,
    extra: Sequence[Metric | PluggedMetric] = (),
    token_counter: Callable[[Column], Column] | PluggedMetric | None = None,
    toxicity: str | Callable[[Column], Column] | PluggedMetric | None = None,
) -> DataFrame:
    """Add one column per metric: the defaults of ``model_type``, if any, and ``extra``.

    The type ``text`` has the token count (by ``token_counter``, where given), both readability
    grades, and toxicity where it can be had: a column of given scores, or a model's function
    of the text. Rows without a prediction have null scores. A metric with ``details`` adds
    its errors beside its scores, as ``<name>_error``.

    Models that come as a ``PluggedMetric``, tokenizer and toxicity included, share one pass:
    each text goes to Python once for all of them.
    """
    metrics = list(extra)
    if model_type is not None:
        counts_tokens = isinstance(token_counter, PluggedMetric)
        df = MODEL_TYPES[model_type](df, predictions, None if counts_tokens else token_counter)
        if counts_tokens:
            metrics.append(replace(token_counter, name="token_count", of_pair=False, kind="bigint"))
        if isinstance(toxicity, str):
            metrics.insert(0, given_score("toxicity", toxicity))
        elif isinstance(toxicity, PluggedMetric):
            metrics.insert(0, replace(toxicity, name="toxicity", of_pair=False, kind="double"))
        elif toxicity:
            metrics.insert(0, Metric("toxicity", lambda pred, target: toxicity(pred)))
    pred, target = F.col(predictions), F.col(targets)
    plugged = [m for m in metrics if isinstance(m, PluggedMetric)]
    own = [m.score(pred, target).alias(m.name) for m in metrics if m not in plugged]
    if plugged:
        own.append(plugged_scores(plugged)(pred, target).alias("_plugged"))
    scored = df.select("*", *own)
    found: dict[str, Column] = {}
    for m in metrics:
        if m in plugged:
            value, error = (F.col("_plugged")[f"{part}{plugged.index(m)}"] for part in "ve")
        else:
            value = F.col(m.name)["value"] if m.details else F.col(m.name)
            error = F.col(m.name)["error"] if m.details else None
        found[m.name] = value
        if m.details:
            found[f"{m.name}_error"] = error
    return scored.withColumns(found).drop("_plugged")


def evaluate_once(
    df: DataFrame,
    targets: str,
    predictions: str,
    table: str,
    score_cols: Sequence[str],
    p: float = 0.9,
    thresholds: dict[str, float] | None = None,
    **how,
) -> tuple[DataFrame, DataFrame]:
    """Score into ``table``, then summarise the stored scores: ``(scores, summary)``.

    Every model is called once per row. ``how`` goes to :func:`evaluate`.
    """
    scores = save_table(evaluate(df, targets, predictions, **how), table)
    return scores, aggregate_scores(scores, score_cols, p, thresholds)


def aggregate_scores(
    scores: DataFrame,
    score_cols: Sequence[str],
    p: float = 0.9,
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """``(metric, stat, value)``: mean, population variance and a percentile per metric.

    ``thresholds`` adds a ``ratio`` for a metric: the share of its scores above a value. Runs at
    once: one pass for the moments of all metrics and an interval for the percentiles, and a few
    narrow passes for these. Pass stored scores (see :func:`evaluate_once`); unsaved ones would
    be computed in each pass, which is wrong for a model whose answers vary.
    """
    thresholds = thresholds or {}
    columns = scores.select(*[F.col(c).cast("double").alias(c) for c in score_cols])
    stats = {(c, "mean"): F.avg(c) for c in score_cols}
    stats |= {(c, "variance"): F.var_pop(c) for c in score_cols}
    stats |= {(c, "ratio"): _share_above(c, t) for c, t in thresholds.items()}
    # The percentiles leave NaN out, the moments do not.
    seen = columns.select("*", *[usable(c).alias(f"_{c}") for c in score_cols])
    row = seen.agg(
        *[s.alias(f"s{i}") for i, s in enumerate(stats.values())],
        *first_look([f"_{c}" for c in score_cols], p),
    ).first()
    found = exact_percentiles(columns, score_cols, p, looks=row)
    out = [(c, s, row[f"s{i}"]) for i, (c, s) in enumerate(stats)]
    out += [(c, f"p{round(100 * p)}", found.get(c)) for c in score_cols]
    return scores.sparkSession.createDataFrame(out, "metric string, stat string, value double")


def metrics_json(metrics: DataFrame) -> DataFrame:
    """The metrics as one JSON document, ``metric/stat`` to value, keys in order."""
    entry = F.struct(F.concat_ws("/", "metric", "stat").alias("key"), "value")
    document = F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry))))
    return metrics.agg(document.alias("metrics"))


def log_metrics(metrics: DataFrame, run_id: str, table: str, evaluation: str | None = None) -> DataFrame:
    """Put the metrics into a table under a run id; several evaluations may share a run.

    The table is partitioned by run and evaluation, and a repeated call replaces what stands for
    both: one set of rows however often a step is tried again. An evaluation without a name
    goes by the metrics it has. Returns the table.
    """
    if evaluation is None:
        evaluation = "+".join(sorted(r.metric for r in metrics.select("metric").distinct().collect()))
        if len(evaluation) > 100:  # names a folder
            evaluation = hashlib.md5(evaluation.encode()).hexdigest()
    rows = metrics.select("metric", "stat", "value", F.lit(run_id).alias("run_id"), F.lit(evaluation).alias("evaluation"))
    return replace_partitions(rows.coalesce(1), table, ["run_id", "evaluation"])
