"""Inference that resumes, retries of refused calls, and several models in one pass."""

import sys
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pairloom.functions.judges import PluggedMetric
from pairloom.functions.model_calls import Retry, call_model, may_pass
from pairloom.functions.payload import GenParams
from pairloom.operators import evaluate as ev
from pairloom.operators import infer, requests
from pairloom.operators.resume import infer_resumable
from pairloom.sources.tables import from_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def counting(folder, die_after=None, broken=()):
    """A model that notes every prompt it answers and may stop the job after some of them."""

    def factory(params):
        def score(prompts):
            for p in prompts:
                if die_after is not None and len(list(Path(folder).iterdir())) >= die_after:
                    raise RuntimeError("killed")
                if p in broken:
                    raise ValueError("cannot read this")
                Path(folder, f"{p}-{time.time_ns()}").touch()
            return [p.upper() for p in prompts]

        return score

    return factory


@pytest.fixture
def asked(tmp_path):
    folder = tmp_path / "asked"
    folder.mkdir()
    return folder


def calls(folder):
    return Counter(p.name.split("-")[0] for p in folder.iterdir())


@pytest.fixture
def prompts(spark):
    return spark.range(0, 120, 1, 2).select("id", F.concat(F.lit("p"), "id").alias("prompt"))


def test_a_killed_job_asks_for_the_rest_alone(spark, prompts, asked, tmp_path):
    path = str(tmp_path / "answers")
    with pytest.raises(Exception, match="killed"):
        infer_resumable(prompts, "prompt", ["id"], counting(asked, 70), path, chunk_rows=20, on_error="raise", call_size=1, tasks=1)
    stored = spark.read.parquet(f"{path}/answers").count()
    before = calls(asked)
    assert 20 <= stored <= sum(before.values()) <= 71
    found = infer_resumable(prompts, "prompt", ["id"], counting(asked), path, chunk_rows=20, run_col="run")
    rows = found.collect()
    assert sorted((r.id, r.llm_response) for r in rows) == [(i, f"P{i}") for i in range(120)]
    assert Counter(r.run for r in rows) == {1: stored, 2: 120 - stored}
    # Stored answers were asked for once; what the lost chunk had asked is asked again.
    assert all(calls(asked)[f"p{r.id}"] == 1 for r in rows if r.run == 1)
    assert sum(calls(asked).values()) - sum(before.values()) == 120 - stored
    again = infer_resumable(prompts, "prompt", ["id"], counting(asked, 0), path, on_error="raise")
    assert again.count() == 120
    assert sorted(p.name for p in (tmp_path / "answers").iterdir()) == ["answers"]


def test_changed_requests_are_asked_again(spark, asked, tmp_path):
    path = str(tmp_path / "answers")
    first = from_rows(spark, [(1, "a"), (2, "b"), (None, "c"), (3, None)], "id long, prompt string")
    second = from_rows(spark, [(1, "a"), (2, "x"), (None, "c"), (3, None)], "id long, prompt string")
    for df in (first, second, second):
        found = infer_resumable(df, "prompt", ["id"], counting(asked), path)
    assert sorted(((r.id, r.prompt, r.llm_response) for r in found.collect()), key=repr) == sorted(
        [(1, "a", "A"), (2, "x", "X"), (None, "c", "C"), (3, None, None)], key=repr
    )
    assert calls(asked) == {"a": 1, "b": 1, "c": 1, "x": 1}
    infer_resumable(second, "prompt", ["id"], counting(asked), path, GenParams(max_tokens=7))
    assert calls(asked) == {"a": 2, "b": 1, "c": 2, "x": 2}


def test_failed_rows_are_asked_again_on_demand(spark, prompts, asked, tmp_path):
    path, some = str(tmp_path / "answers"), prompts.where("id < 30")
    first = infer_resumable(some, "prompt", ["id"], counting(asked, broken=("p3", "p4")), path, chunk_rows=10, call_size=1)
    assert {r.id for r in first.where("error IS NOT NULL").collect()} == {3, 4}
    kept = infer_resumable(some, "prompt", ["id"], counting(asked), path)
    assert kept.where("error IS NOT NULL").count() == 2 and sum(calls(asked).values()) == 28
    better = infer_resumable(some, "prompt", ["id"], counting(asked, broken=("p4",)), path, retry_errors=True, run_col="run", call_size=1)
    assert [(r.id, r.run) for r in better.where("error IS NOT NULL").collect()] == [(4, 2)]
    assert better.count() == 30 and sum(calls(asked).values()) == 29


def test_nothing_to_ask(spark, prompts, asked, tmp_path):
    found = infer_resumable(prompts.limit(0), "prompt", ["id"], counting(asked), str(tmp_path / "a"), run_col="run")
    assert found.columns == ["id", "prompt", "llm_response", "error", "run"] and found.isEmpty()


class Refused(Exception):
    def __init__(self, status, retry_after=None):
        super().__init__(f"status {status}")
        self.status_code, self.retry_after = status, retry_after


def flaky(failures):
    """A model whose first calls fail, one for each of ``failures``."""
    left, seen = list(failures), []

    def model(prompts):
        seen.append(list(prompts))
        if left:
            raise left.pop(0)
        return [p.upper() for p in prompts]

    return model, seen


QUICK = Retry(attempts=4, wait=0.001, jitter=0)


def test_refused_calls_are_tried_again():
    model, seen = flaky([Refused(429), Refused(503), TimeoutError()])
    assert call_model(model, [["a", None, "b"]], retry=QUICK) == [("A", None, 4), (None, None, 0), ("B", None, 4)]
    assert seen == [["a", "b"]] * 4


def test_other_failures_are_not():
    model, seen = flaky([Refused(400), Refused(404)])
    assert call_model(model, [["a", "b"]], retry=QUICK) == [(None, "status 404", 2), ("B", None, 2)]
    assert [len(s) for s in seen] == [2, 1, 1]
    with pytest.raises(Refused):
        call_model(flaky([Refused(400)])[0], [["a"]], "raise", retry=QUICK)


def test_giving_up_after_all_attempts():
    model, seen = flaky([Refused(500)] * 4)
    assert call_model(model, [["a"]], retry=QUICK) == [(None, "status 500", 4)]
    with pytest.raises(Refused):
        call_model(flaky([Refused(500)] * 9)[0], [["a"]], "raise", retry=QUICK)


def test_waits_grow_up_to_a_limit_and_heed_the_server():
    retry = Retry(attempts=9, wait=1, growth=3, longest=20, jitter=0)
    assert [retry.pause(Refused(429), n) for n in (1, 2, 3, 4, 8, 9)] == [1, 3, 9, 20, 20, None]
    assert retry.pause(Refused(429, retry_after=30), 1) == 30
    spread = {Retry(attempts=2, wait=1, jitter=0.5).pause(Refused(429), 1) for _ in range(50)}
    assert len(spread) > 10 and all(1 <= w <= 1.5 for w in spread)
    held = Exception()
    held.response = Refused(502)
    assert may_pass(held) and may_pass(ConnectionResetError()) and not may_pass(ValueError(429))


def test_calls_go_by_length_and_answers_come_back_in_order():
    model, seen = flaky([])
    texts = ["ccc", "a", None, "dddd", "bb", "e"]
    assert [v for v, _, _ in call_model(model, [texts], call_size=2, by_length=True)] == ["CCC", "A", None, "DDDD", "BB", "E"]
    assert seen == [["a", "e"], ["bb", "ccc"], ["dddd"]]


def once_refused(marks):
    def factory(params):
        def score(prompts):
            first = not Path(marks).exists()
            Path(marks).touch()
            if first:
                raise Refused(429)
            return [p.upper() for p in prompts]

        return score

    return factory


def test_attempts_are_counted_per_row(spark, tmp_path):
    df = from_rows(spark, [("a",), (None,), ("bb",)], "prompt string").coalesce(1)
    out = infer.batch_infer(df, "prompt", once_refused(str(tmp_path / "m")), retry=QUICK, attempts_col="attempts")
    assert [(r.llm_response, r.attempts) for r in out.collect()] == [("A", 2), (None, 0), ("BB", 2)]
    packed = from_rows(spark, [(["a", "b"],)], "prompts array<string>")
    sent = requests.infer_batches(packed, once_refused(str(tmp_path / "n")), retry=QUICK)
    assert sent.first().error is None


def grades():
    return lambda preds, truths: [len(p) - len(t) for p, t in zip(preds, truths)]


def refusing():
    def judge(preds, truths):
        if "bad" in preds:
            raise ValueError("cannot judge this")
        return [0.5] * len(preds)

    return judge


def lengths():
    return lambda texts: [len(t) for t in texts]


def test_all_models_share_one_pass(spark):
    df = from_rows(spark, [("abc", "a"), ("bad", "b"), (None, "c"), ("d", None)], "pred string, truth string").coalesce(1)
    judges = [
        PluggedMetric("longer", grades), PluggedMetric("kind", refusing, kind="double", details=True), ev.ANSWER_SIMILARITY,
    ]
    scored = ev.evaluate(
        df, "truth", "pred", "text", judges,
        token_counter=PluggedMetric("t", lengths), toxicity=PluggedMetric("t", lengths),
    )
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    rows = scored.collect()
    assert [(r.longer, r.kind, r.kind_error, r.token_count, r.toxicity) for r in rows] == [
        (2, 0.5, None, 3, 3.0), (2, None, "cannot judge this", 3, 3.0), (None, None, None, None, None), (None, None, None, 1, 1.0),
    ]
    assert set(scored.columns) == {
        "pred", "truth", "token_count", "flesch_kincaid_grade", "ari_grade", "answer_similarity", "toxicity", "longer", "kind", "kind_error",
    }
