"""Scores, exact percentiles, summaries, and checks before training."""

import json
from itertools import zip_longest

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions.judges import (
    correctness,
    judge_udf,
    similarity,
    text_score_udf,
    token_count_udf,
)
from pairloom.operators import evaluate as ev
from pairloom.operators import handoff
from pairloom.operators.percentile import exact_percentiles
from pairloom.sources.tables import drop_table, from_rows


def test_judges(spark):
    rows = [("a b", "A b"), ("a", "b"), ("a b c d", "a b"), ("", ""), (None, "a"), ("a", None)]
    df = from_rows(spark, rows, "p string, t string")
    found = df.select(similarity(F.col("p"), F.col("t")), correctness(F.col("p"), F.col("t"))).collect()
    assert list(map(tuple, found)) == [(5, 5), (1, 1), (3, 5), (None, None), (None, None), (None, None)]


def test_a_judge_plugs_in(spark):
    def factory():
        return lambda preds, truths: [5 if p == t else 1 for p, t in zip(preds, truths)]

    df = from_rows(spark, [("a", "a"), ("a", "b")], "p string, t string")
    judged = ev.judge_similarity(df, "p", "t", judge_udf(factory))
    assert [r.answer_similarity for r in judged.collect()] == [5, 1]
    judged = ev.judge_correctness(df, "p", "t", judge_udf(factory))
    assert [r.answer_correctness for r in judged.collect()] == [5, 1]


def test_a_toxicity_model_plugs_in(spark):
    def factory():
        return lambda texts: [float("!" in t) for t in texts]

    df = from_rows(spark, [("a!", "a"), ("b", "b"), (None, "c")], "p string, t string")
    score = text_score_udf(factory)
    scored = ev.evaluate(df, "t", "p", extra=[ev.Metric("toxicity", lambda pred, target: score(pred))])
    assert [r.toxicity for r in scored.collect()] == [1.0, 0.0, None]
    assert ev.toxicity(scored, "toxicity").first().toxicity_ratio == 0.5


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_failing_judge_costs_one_row(spark, small_batches):
    """The judge cannot take nulls, gets none, and fails on one pair."""

    def factory():
        def grade(preds, truths):
            if any("bad" in p for p in preds):
                raise ValueError("cannot grade")
            return [len(set(p.split()) & set(t.split())) for p, t in zip(preds, truths)]

        return grade

    rows = [("a b", "a"), (None, "a"), ("bad", "a"), ("a", None)] + [("x", "x")] * 10
    df = from_rows(spark, rows, "p string, t string").coalesce(1)
    judge = judge_udf(factory, call_size=4, details=True)
    found = ev.evaluate(df, "t", "p", extra=[ev.Metric("grade", judge, details=True)]).collect()
    assert [(r.grade, r.grade_error) for r in found[:4]] == [(1, None), (None, None), (None, "cannot grade"), (None, None)]
    assert all((r.grade, r.grade_error) == (1, None) for r in found[4:])
    with pytest.raises(Exception, match="cannot grade"):
        ev.judge_similarity(df, "p", "t", judge_udf(factory, on_error="raise")).collect()


def test_every_model_is_called_once_per_row(spark, tmp_path):
    log = str(tmp_path / "calls")

    def factory():
        def grade(preds, truths):
            with open(log, "a") as f:
                f.write("x" * len(preds))
            return [len(p) for p in preds]

        return grade

    df = spark.range(0, 40, 1, 2).select(F.concat(F.lit("p"), "id").alias("p"), F.lit("t").alias("t"))
    metric = ev.Metric("grade", judge_udf(factory))
    drop_table(spark, "once")
    scores, summary = ev.evaluate_once(
        df, "t", "p", "once", ["grade", "token_count"], model_type="text", extra=[metric], token_counter=F.length
    )
    document = json.loads(ev.metrics_json(summary).first().metrics)
    assert document["grade/mean"] == document["token_count/mean"] == 2.75
    assert scores.count() == 40 and open(log).read() == "x" * 40
    drop_table(spark, "once")


def test_text_defaults_take_a_toxicity_model(spark):
    score = text_score_udf(lambda: lambda texts: [float("!" in t) for t in texts])
    df = from_rows(spark, [("a!", "a"), (None, "b")], "p string, t string")
    scored = ev.evaluate(df, "t", "p", "text", toxicity=score, token_counter=token_count_udf(lambda: len))
    assert [(r.token_count, r.toxicity) for r in scored.collect()] == [(2, 1.0), (None, None)]


def test_a_tokenizer_plugs_in(spark):
    counter = token_count_udf(lambda: len)
    df = from_rows(spark, [("train", "ab c", "d"), ("train", "", None)], f"split string, {PAIR}")
    found = ev.text_metrics(df, "response", counter).orderBy(F.desc("prompt")).collect()
    assert [r.token_count for r in found] == [1, None]
    profile = handoff.training_profile(df.fillna(""), 2, token_counter=counter).first()
    assert (profile.n_rows, profile.n_tokens, profile.total_tokens) == (2, 5, 10)


def test_default_metrics_can_be_off(spark):
    df = from_rows(spark, [("a", "a")], "p string, t string")
    assert ev.evaluate(df, "t", "p", extra=[ev.ANSWER_SIMILARITY]).columns == ["p", "t", "answer_similarity"]
    assert ev.evaluate(df, "t", "p", "text").columns == [
        "p", "t", "token_count", "flesch_kincaid_grade", "ari_grade",
    ]


def test_toxicity_leaves_unscored_rows_out(spark):
    df = from_rows(spark, [(0.9,), (0.5,), (0.1,), (None,)], "score double")
    found = ev.toxicity(df, "score").first()
    assert (found.n_rows, found.n_scored) == (4, 3)
    assert found.toxicity_ratio == pytest.approx(1 / 3)


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 0.999, 1.0])
def test_percentile_of_few_rows(spark, p):
    sizes = (1, 2, 9, 10, 11, 100)
    values = [np.random.default_rng(n).normal(size=n).tolist() for n in sizes]
    rows = list(zip_longest(*values))  # shorter columns end in nulls
    df = from_rows(spark, rows, ", ".join(f"n{n} double" for n in sizes))
    found = exact_percentiles(df, df.columns, p)
    wanted = {f"n{n}": np.percentile(of_n, 100 * p) for n, of_n in zip(sizes, values)}
    assert found == pytest.approx(wanted)


def test_percentile_with_infinite_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(-inf, inf, None), (1.0, inf, nan), (2.0, None, nan), (inf, None, None), (nan, None, None)]
    df = from_rows(spark, rows, "some double, all double, none double")
    assert exact_percentiles(df, df.columns, 0.5) == {"some": 1.5, "all": inf}


def skewed(spark):
    """300,000 rows: normal, one value for a third of them, far outliers, one value, integers."""
    i = F.col("id")
    noise = F.randn(3)
    values = {
        "normal": noise,
        "hot": F.when(i % 3 == 0, 1.25).otherwise(noise),
        "far": F.when(i % 1000 == 0, noise * 1e12).otherwise(noise),
        "flat": F.lit(2.5),
        "whole": F.floor(noise * 3),
    }
    return spark.range(0, 300_000, 1, 8).select(*[v.alias(k) for k, v in values.items()])


def built_in_percentiles(df, p):
    return df.agg(*[F.percentile(c, p).alias(c) for c in df.columns]).first().asDict()


@pytest.mark.parametrize("accuracy", [10_000, 1000, 50])
def test_percentile_of_many_rows(spark, accuracy):
    df = skewed(spark)
    found = exact_percentiles(df, df.columns, 0.9, accuracy=accuracy, bins=64)
    assert found == pytest.approx(built_in_percentiles(df, 0.9), rel=1e-12)


def test_a_poor_proposal_still_gives_the_exact_answer(spark, monkeypatch):
    """Bounds that miss the rank altogether only make the step outside them the chosen one."""
    df = skewed(spark)
    wanted = built_in_percentiles(df, 0.9)
    honest = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, p, a: honest(c, [0.2, 0.3], a))
    assert exact_percentiles(df, df.columns, 0.9) == pytest.approx(wanted)


def test_percentile_where_values_crowd(spark):
    """Half of the values lie within a billionth of the percentile."""
    i = F.col("id")
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(i % 2 == 0, i / 1e15 + 5).otherwise(F.rand(1) * 10).alias("crowd"),
        F.pow(F.lit(2.0), -(i % 900)).alias("powers"),
        F.when(i % 10 == 0, F.lit(float("-inf"))).when(i % 10 == 1, F.lit(1e308)).otherwise(-1e308 + i).alias("wide"),
    )
    for p in (0.5, 0.6, 0.05):
        assert exact_percentiles(df, df.columns, p) == pytest.approx(built_in_percentiles(df, p), rel=1e-12)


def test_no_window_over_values(spark):
    from pairloom.operators.percentile import _Search, _steps

    plan = _steps(skewed(spark), [_Search("hot", 3, 0.0, 1.0)], 64)._jdf.queryExecution().executedPlan().toString()
    window = plan.index("Window ")
    assert "score" not in plan[window : plan.index("\n", window)]


def test_summary(spark):
    rows = [(1, 1.0), (2, 0.0), (4, None)]
    df = from_rows(spark, rows, "score int, toxic double")
    found = ev.aggregate_scores(df, ["score", "toxic"], thresholds={"toxic": 0.5})
    values = {(r.metric, r.stat): r.value for r in found.collect()}
    assert values == pytest.approx(
        {
            ("score", "mean"): 7 / 3,
            ("score", "variance"): np.var([1, 2, 4]),
            ("score", "p90"): np.percentile([1, 2, 4], 90),
            ("toxic", "mean"): 0.5,
            ("toxic", "variance"): 0.25,
            ("toxic", "p90"): 0.9,
            ("toxic", "ratio"): 0.5,
        }
    )


def test_summary_of_a_metric_without_scores(spark):
    df = from_rows(spark, [(None,)], "score double")
    found = ev.aggregate_scores(df, ["score"])
    assert sorted((r.stat, r.value) for r in found.collect()) == [
        ("mean", None), ("p90", None), ("variance", None),
    ]


def test_metrics_json(spark):
    metrics = from_rows(spark, [("b", "mean", 2.0), ("a", "p90", 0.5)], "metric string, stat string, value double")
    found = ev.metrics_json(metrics).first().metrics
    assert json.loads(found) == {"a/p90": 0.5, "b/mean": 2.0}
    assert list(json.loads(found)) == ["a/p90", "b/mean"]


def test_metrics_json_keeps_doubles(spark):
    values = [1.5e-7, 1e20, None]
    rows = [(f"m{i}", "mean", v) for i, v in enumerate(values)]
    metrics = from_rows(spark, rows, "metric string, stat string, value double")
    found = json.loads(ev.metrics_json(metrics).first().metrics)
    assert [found.get(f"m{i}/mean") for i in range(3)] == values


def test_runs_add_up_in_one_table(spark):
    metrics = from_rows(spark, [("m", "mean", 1.0)], "metric string, stat string, value double")
    drop_table(spark, "run_log")
    ev.log_metrics(metrics, "r1", "run_log")
    ev.log_metrics(metrics.withColumn("metric", F.lit("n")), "r1", "run_log")
    ev.log_metrics(metrics, "r2", "run_log")
    assert sorted((r.run_id, r.metric) for r in spark.table("run_log").collect()) == [
        ("r1", "m"), ("r1", "n"), ("r2", "m"),
    ]
    drop_table(spark, "run_log")


PAIR = "prompt string, response string"


def test_validation_counts(spark):
    train = from_rows(spark, [("p", "r"), ("p", "r"), ("q", "s"), ("", "x"), (None, "x")], PAIR)
    evaluation = from_rows(spark, [("p", "r"), ("q", "t"), ("z", None)], PAIR)
    assert handoff.validate_ift(train, evaluation).first().asDict() == {
        "train_rows": 5,
        "eval_rows": 3,
        "train_unfit": 2,
        "eval_unfit": 1,
        "shared_pairs": 1,
        "shared_prompts": 2,
    }


def test_validation_of_nothing(spark):
    none = from_rows(spark, [], PAIR)
    assert set(handoff.validate_ift(none, none).first()) == {0}


def test_validation_needs_the_pair_columns(spark):
    good = from_rows(spark, [("p", "r")], PAIR)
    with pytest.raises(ValueError, match="prompt"):
        handoff.validate_ift(good, good.withColumn("extra", F.lit(1)))


def test_validation_shuffles_no_text(spark):
    texts = from_rows(spark, [("p", "r")], PAIR)
    plan = handoff.validate_ift(texts, texts)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("prompt#" in line or "response#" in line for line in exchanges)


def test_one_frame_is_validated_in_one_scan(spark, tmp_path):
    rows = [("p", "r", "train"), ("q", "s", "train"), ("p", "r", "eval"), ("x", "y", "test")]
    from_rows(spark, rows, f"{PAIR}, split string").write.parquet(str(tmp_path / "pairs"))
    found = handoff.validate_split(spark.read.parquet(str(tmp_path / "pairs")))
    assert tuple(found.first()) == (2, 1, 0, 0, 1, 1)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_counts_shuffle_no_text(spark):
    from pairloom.plans import dataset

    for query in (dataset.row_count, dataset.split_counts, dataset.hash_split, dataset.training_profile, dataset.validate_ift):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange" in line]
        assert exchanges
        if query is not dataset.validate_ift:  # its pairs come from rows with their texts
            assert not any(f"{c}#" in line for line in exchanges for c in ("text", "title", "prompt", "response"))


def test_profile_and_record(spark):
    df = from_rows(spark, [("train", "a b", "c"), ("train", "d", "e f"), ("eval", "g", "h")], f"split string, {PAIR}")
    found = {r.split: tuple(r)[1:] for r in handoff.training_profile(df, 3).collect()}
    assert found == {"train": (2, 6, 18), "eval": (1, 2, 6)}
    record = handoff.unpivot_record(from_rows(spark, [("n", 3, None)], "name string, epochs int, note string"), ["name", "epochs", "note"])
    assert list(map(tuple, record.collect())) == [("name", "n"), ("epochs", "3"), ("note", None)]
