"""Batch inference, payloads, request batches and attached predictions."""

import json
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pairloom.functions import payload
from pairloom.functions.payload import GenParams
from pairloom.operators import infer, requests
from pairloom.sources.tables import from_rows, load_dir

# The scorers below go to the workers with the job, as those of a notebook do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def shout(params):
    return lambda prompts: [p.upper() for p in prompts]


def picky(params):
    def scorer(prompts):
        if any("bad" in p for p in prompts):
            raise ValueError("cannot read this")
        return [p.upper() for p in prompts]

    return scorer


def short(params):
    return lambda prompts: prompts[:-1]


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_every_arrow_batch_is_answered(spark, small_batches):
    df = spark.range(0, 1000, 1, 1).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    out = infer.batch_infer(df, "prompt", shout, call_size=7)
    assert out.count() == 1000
    assert out.where(F.col("llm_response") == F.upper("prompt")).count() == 1000


def test_factory_runs_once_per_task(spark, small_batches, tmp_path):
    log = str(tmp_path / "starts")

    def factory(params):
        with open(log, "a") as f:
            f.write("start\n")
        return lambda prompts: prompts

    df = spark.range(0, 1000, 1, 2).select(F.col("id").cast("string").alias("prompt"))
    infer.batch_infer(df, "prompt", factory).write.format("noop").mode("overwrite").save()
    assert open(log).read().count("start") == 2


def test_rows_spread_over_the_tasks_asked_for(spark):
    df = spark.range(0, 1000, 1, 1).select(F.col("id").cast("string").alias("prompt"))
    out = infer.batch_infer(df, "prompt", shout, tasks=5).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in out.groupBy("task").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 300


def test_lead_scorer_and_its_params(spark):
    df = from_rows(spark, [("a b c d",), ("a",), ("",), ("x  y z",)], "prompt string")
    out = infer.batch_infer(df, "prompt", infer.lead_scorer(), GenParams(max_tokens=3))
    assert [r.llm_response for r in out.collect()] == ["a b c", "a", "", "x  y"]


def test_one_failing_prompt_costs_only_its_own_row(spark):
    df = from_rows(spark, [("good",), ("bad",), ("fine",), (None,)], "prompt string").coalesce(1)
    out = infer.batch_infer(df, "prompt", picky, out_col="text", error_col="error")
    assert [(r.text, r.error) for r in out.collect()] == [
        ("GOOD", None),
        (None, "cannot read this"),
        ("FINE", None),
        (None, None),
    ]


def test_a_failure_can_fail_the_job(spark):
    df = from_rows(spark, [("bad",)], "prompt string")
    with pytest.raises(Exception, match="cannot read this"):
        infer.batch_infer(df, "prompt", picky, on_error="raise").collect()


def test_a_scorer_must_answer_every_prompt(spark):
    df = from_rows(spark, [("a",), ("b",)], "prompt string").coalesce(1)
    out = infer.batch_infer(df, "prompt", short, error_col="error").collect()
    assert all("0 texts for 1 prompts" in r.error for r in out)


def test_calls_are_not_repeated_by_the_optimizer(spark):
    df = from_rows(spark, [("a",)], "prompt string")
    out = infer.batch_infer(df, "prompt", shout, error_col="error").where(F.col("llm_response") != "b")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_request_payload(spark):
    df = from_rows(spark, [(['q "1"', "é\n"],)], "prompts array<string>")
    found = df.select(payload.request_payload(F.col("prompts"), GenParams(128, 0.9)).alias("r")).first().r
    assert json.loads(found) == {
        "inputs": {"prompt": ['q "1"', "é\n"]},
        "params": {"max_tokens": 128, "temperature": 0.9},
    }


def test_responses(spark):
    rows = [
        (json.dumps({"predictions": [{"candidates": [{"text": "a"}, {"text": "n"}]}, {"candidates": []}]}),),
        ("{oops",),
        ("{}",),
        (None,),
    ]
    df = from_rows(spark, rows, "doc string")
    found = df.select(
        payload.response_text(F.col("doc")).alias("one"), payload.response_texts(F.col("doc")).alias("all")
    ).collect()
    assert [r.one for r in found] == ["a", None, None, None]
    assert [r.all for r in found] == [["a", None], None, None, None]


def test_unbatch_keeps_a_row_for_every_key(spark):
    one = '{"predictions":[{"candidates":[{"text":"a"}]}]}'
    two = '{"predictions":[{"candidates":[{"text":"b"}]},{"candidates":[{"text":"surplus"}]}]}'
    rows = [([(1,), (2,)], one), ([(3,)], "{oops"), ([(4,)], two), ([], one)]
    df = from_rows(spark, rows, "keys array<struct<id: long>>, answer string")
    found = requests.unbatch_responses(df, "answer", "keys", "text")
    wanted = [(1, 0, "a"), (2, 1, None), (3, 0, None), (4, 0, "b")]
    assert sorted(map(tuple, found.collect())) == wanted


def batches_of(df, **options):
    return requests.batch_requests(df, "text", 8, ["conv_id", "turn"], rows_per_bucket=64, **options)


@pytest.mark.parametrize("parts", [1, 7])
def test_request_batches_ignore_the_layout(spark, parts):
    turns = load_dir(spark, "/root/testdata/sf0.01", "conversations.parquet")
    plain, moved = batches_of(turns), batches_of(turns.repartition(parts))
    assert plain.count() == moved.count()
    assert plain.select("request").exceptAll(moved.select("request")).count() == 0


def test_request_batches_hold_every_row_once(spark):
    turns = load_dir(spark, "/root/testdata/sf0.01", "conversations.parquet")
    for unique in (False, True):
        found = batches_of(turns, unique_key=unique)
        assert found.agg(F.max(F.size("prompts"))).first()[0] == 8
        keys = found.select(F.explode("keys").alias("k")).select("k.*")
        assert sorted(keys.collect()) == sorted(turns.select("conv_id", "turn").collect())


def test_no_bucket_fills_with_copies_of_one_row(spark):
    """A third of all rows are one row, another third share its key."""
    rows = (
        [(0, 0, "same")] * 1000
        + [(0, 0, f"other {i}") for i in range(1000)]
        + [(i, 1, "x") for i in range(1000)]
    )
    df = from_rows(spark, rows, "conv_id long, turn long, text string")
    found = batches_of(df).collect()
    sizes = Counter()
    for r in found:
        sizes[r.bucket] += len(r.prompts)
    assert sum(sizes.values()) == 3000
    assert len(sizes) > 40 and max(sizes.values()) < 64 * 5
    sent = Counter(p for r in found for p in r.prompts)
    assert sent["same"] == 1000 and sent["x"] == 1000


def test_batches_add_no_shuffle_to_the_window(spark):
    turns = load_dir(spark, "/root/testdata/sf0.01", "conversations.parquet")
    plan = batches_of(turns, unique_key=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_a_failing_request_costs_that_request_alone(spark):
    rows = [([(1,), (2,)], ["a", "b"]), ([(3,)], ["bad"]), ([(4,)], [None]), ([(5,)], ["c"]), ([], [])]
    df = from_rows(spark, rows, "keys array<struct<id: long>>, prompts array<string>").coalesce(1)
    sent = requests.infer_batches(df, picky)
    assert [r.error is None for r in sent.collect()] == [True, False, False, True, True]
    found = requests.unbatch_responses(sent, "answer", "keys", "text")
    wanted = [(1, 0, "A"), (2, 1, "B"), (3, 0, None), (4, 0, None), (5, 0, "C")]
    assert sorted(map(tuple, found.collect())) == wanted


def test_repeated_predictions_do_not_repeat_rows(spark):
    df = from_rows(spark, [(1, "a"), (2, "b")], "id long, prompt string")
    preds = from_rows(spark, [(1, "B"), (1, "A"), (2, None)], "id long, text string")
    found = infer.attach_predictions(df, preds, "id")
    assert sorted(map(tuple, found.collect())) == [(1, "a", "A"), (2, "b", None)]


def test_attached_predictions_leave_other_rows_null(spark):
    df = from_rows(spark, [(1, "a"), (2, "b"), (3, "c")], "id long, prompt string")
    preds = from_rows(spark, [(1, "A"), (2, "B")], "id long, text string")
    found = infer.attach_predictions(df, preds, "id")
    assert sorted(map(tuple, found.collect())) == [(1, "a", "A"), (2, "b", "B"), (3, "c", None)]


def test_payload_log_of_failures(spark):
    rows = [(1, "p", "t", None), (2, "q", None, "too long"), (3, None, None, None)]
    df = from_rows(spark, rows, "id long, prompt string, text string, error string")
    log = infer.payload_log(df, "id", "prompt", "text", "error", GenParams(), "m").orderBy("request_id")
    ok, failed, unsent = log.collect()
    assert (ok.status, failed.status, unsent.status, unsent.response) == (200, 400, 204, None)
    assert json.loads(ok.response) == {"predictions": [{"candidates": [{"text": "t"}]}]}
    assert json.loads(failed.response) == {"error": "too long"}
