"""Built-in judges, and where models that grade, score or tokenize plug in.

The built-in judges give integer grades 1 to 5 from the tokens two answers share. They
stand in for a model that reads both answers. Each ``*_udf`` takes a factory that is
called once per task and hands its model Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Literal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions.model_calls import OnError, Retry, call_model
from pairloom.functions.readability import WHITE, distinct_tokens


def _grade(shared: Column, total: Column) -> Column:
    """1 for nothing shared up to 5 for all shared; null where there is nothing to share."""
    # Dividing by zero is the null; a test of the total would compute it twice.
    return (1 + F.floor(F.try_divide(4 * shared, total))).cast("int")


def similarity(pred: Column, truth: Column) -> Column:
    """Tokens in both answers, out of those in either."""
    p, t = distinct_tokens(pred), distinct_tokens(truth)
    return _grade(F.array_size(F.array_intersect(p, t)), F.array_size(F.array_union(p, t)))


def correctness(pred: Column, truth: Column) -> Column:
    """Tokens of the true answer that the prediction has."""
    p, t = distinct_tokens(pred), distinct_tokens(truth)
    return _grade(F.array_size(F.array_intersect(p, t)), F.array_size(t))


def _shared_tokens(of_both: bool):
    """The built-in judges as models outside Spark, to show how such ones plug in."""

    def tokens(text: str) -> set[str]:
        return {t for t in re.split(WHITE, text.lower()) if t}

    def judge(preds: list[str], truths: list[str]) -> list[int | None]:
        grades = []
        for p, t in zip(map(tokens, preds), map(tokens, truths)):
            total = len(p | t) if of_both else len(t)
            grades.append(1 + 4 * len(p & t) // total if total else None)
        return grades

    return judge


def similarity_model():
    return _shared_tokens(True)


def correctness_model():
    return _shared_tokens(False)


def token_count_udf(
    factory: Callable[[], Callable[[str], int]],
) -> Callable[[Column], Column]:
    """Tokens per text by a model's own tokenizer; null for null."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = factory()
        for texts in batches:
            yield pd.Series([None if t is None else tokens(t) for t in texts], dtype="Int64")

    return count


def text_score_udf(
    factory: Callable[[], Callable[[list[str]], list[float]]],
    on_error: OnError = "null",
    call_size: int = 64,
    details: bool = False,
) -> Callable[[Column], Column]:
    """A score per text, such as toxicity; null for a null text.

    With ``details`` the column is ``struct<value, error>``, so that a failure shows its reason.
    """

    @F.pandas_udf("value double, error string")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = factory()
        for texts in batches:
            yield _answers(call_model(model, [texts.tolist()], on_error, call_size), "Float64")

    return _column(score.asNondeterministic(), details)


def judge_udf(
    factory: Callable[[], Callable[[list[str], list[str]], list[int]]],
    on_error: OnError = "null",
    call_size: int = 64,
    details: bool = False,
) -> Callable[[Column, Column], Column]:
    """A grade per pair of texts; null where either is null. ``details`` as above."""

    @F.pandas_udf("value int, error string")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        grade = factory()
        for pred, truth in batches:
            pairs = [pred.tolist(), truth.tolist()]
            yield _answers(call_model(grade, pairs, on_error, call_size), "Int32")

    return _column(judge.asNondeterministic(), details)


_DTYPES = {"int": "Int32", "bigint": "Int64", "double": "Float64"}


@dataclass(frozen=True)
class PluggedMetric:
    """A score by a plugged-in model: of both texts, or of the prediction alone.

    ``factory`` is called once per task; its model takes lists of texts and gives as many
    values. ``details`` adds the reasons of failures as ``<name>_error``.
    """

    name: str
    factory: Callable[[], Callable[..., Sequence]]
    of_pair: bool = True
    kind: Literal["int", "bigint", "double"] = "int"
    details: bool = False
    on_error: OnError = "null"
    call_size: int = 64
    retry: Retry = Retry()


def plugged_scores(metrics: Sequence[PluggedMetric]) -> Callable[[Column, Column], Column]:
    """All of ``metrics`` by one function of (prediction, target), in one pass over the texts.

    Gives a struct with ``v0, e0, v1, e1, ...``: value and error of each metric, in order. However
    many models there are, texts go to Python once; a failure costs its own metric alone.
    """
    fields = ", ".join(f"v{i} {m.kind}, e{i} string" for i, m in enumerate(metrics))

    @F.pandas_udf(fields)
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        models = [m.factory() for m in metrics]
        for pred, truth in batches:
            pairs, columns = [pred.tolist(), truth.tolist()], {}
            for i, (m, model) in enumerate(zip(metrics, models)):
                inputs = pairs if m.of_pair else pairs[:1]
                found = call_model(model, inputs, m.on_error, m.call_size, m.retry)
                parts = _answers(found, _DTYPES[m.kind])
                columns |= {f"v{i}": parts["value"], f"e{i}": parts["error"]}
            yield pd.DataFrame(columns)

    return score.asNondeterministic()


def _answers(found: list[tuple], dtype: str) -> pd.DataFrame:
    values = pd.Series([value for value, *_ in found], dtype=dtype)
    return pd.DataFrame({"value": values, "error": pd.Series([e for _, e, _ in found], dtype=object)})


def _column(udf: Callable[..., Column], details: bool) -> Callable[..., Column]:
    return udf if details else lambda *texts: udf(*texts)["value"]
