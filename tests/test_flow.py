"""Both tracks from table to metrics, as a user runs them."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pairloom.functions.payload import GenParams
from pairloom.functions.text import DOCSTRING_TEMPLATE, TITLE_TEMPLATE, add_prompt, between_delimiters
from pairloom.operators import evaluate as ev
from pairloom.operators import handoff, infer, requests, rows, splits
from pairloom.plans import views
from pairloom.sources import jsonl, tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def db(spark, tmp_path):
    tables.ensure_namespace(spark, "flow_test", str(tmp_path / "db"), use=False)
    yield "flow_test"
    spark.sql("DROP DATABASE flow_test CASCADE")


def test_documentation_track(spark, db, tmp_path):
    tables.save_table(views.code_elements(spark, SF_DIR), f"{db}.code")
    functions = rows.select_documented_functions(tables.load_table(spark, f"{db}.code"))
    pairs = add_prompt(functions, DOCSTRING_TEMPLATE, "fn_def").select(
        "prompt", F.col("doc_string").alias("response")
    )
    sides = splits.save_splits(
        splits.hash_split(pairs, {"train": 0.5, "eval": 0.5}, 42, ["prompt"]), f"{db}.pairs"
    )
    for side in ("train", "eval"):
        chosen = sides.where(F.col("split") == side).select("prompt", "response")
        jsonl.export_single_jsonl(chosen, str(tmp_path / f"{side}.jsonl"))
    train, evaluation = (jsonl.read_jsonl(spark, str(tmp_path / f"{s}.jsonl")) for s in ("train", "eval"))
    checked = handoff.validate_ift(train, evaluation).first()
    assert checked.train_rows > 0 and checked.eval_rows > 0
    assert checked.train_rows + checked.eval_rows == pairs.count()
    assert (checked.train_unfit, checked.eval_unfit, checked.shared_prompts) == (0, 0, 0)

    def writes_docstrings(params):
        return lambda prompts: [f'def f():\n    """Doc of {len(p)} characters."""' for p in prompts]

    generated = infer.batch_infer(evaluation, "prompt", writes_docstrings, out_col="raw")
    output = tables.save_table(
        generated.select("*", between_delimiters(F.col("raw")).alias("llm_response")).drop("raw"),
        f"{db}.output",
    )
    assert output.where(F.col("llm_response").startswith("Doc of ")).count() == checked.eval_rows

    judges = [ev.ANSWER_CORRECTNESS, ev.ANSWER_SIMILARITY]
    scored = ev.evaluate(rows.to_eval_frame(output), "ground_truth", "llm_response", "text", judges)
    names = [c for c in scored.columns if c not in ("inputs", "ground_truth", "llm_response")]
    summary = ev.aggregate_scores(scored, names)
    ev.log_metrics(summary, "run", f"{db}.metrics")
    assert spark.table(f"{db}.metrics").count() == 3 * len(names)
    document = json.loads(ev.metrics_json(summary).first().metrics)
    assert document["token_count/mean"] == 4.0


def test_title_track_with_batched_requests(spark, db, tmp_path):
    posts = rows.filter_null_or_empty(views.blogs(spark, SF_DIR), ["text", "title"])
    posts = rows.dedup(posts, ["text", "title"], order_by="doc_id")
    pairs = add_prompt(posts, TITLE_TEMPLATE, "text").select(
        F.col("doc_id").alias("row_key"), "prompt", F.col("title").alias("response")
    )
    assert pairs.count() == 142
    pairs = tables.save_table(splits.hash_split(pairs, {"train": 0.9, "eval": 0.1}, 42, ["prompt"]), f"{db}.titles")
    evaluation = pairs.where(F.col("split") == "eval").drop("split")

    batches = requests.batch_requests(
        evaluation, "prompt", 4, ["row_key"], GenParams(128, 0.9), unique_key=True
    )
    sent = [json.loads(r.request) for r in batches.collect()]
    assert {p for s in sent for p in s["inputs"]["prompt"]} == {r.prompt for r in evaluation.collect()}
    assert all(s["params"] == {"max_tokens": 128, "temperature": 0.9} for s in sent)

    def titles_of(params):
        return lambda prompts: [p[:10] for p in prompts]

    answered = requests.infer_batches(batches, titles_of, GenParams(128, 0.9))
    titles = requests.unbatch_responses(answered, "answer", "keys", "generated_title").drop("pos")
    frame = infer.attach_predictions(rows.to_eval_frame(evaluation), titles, "row_key")
    assert frame.count() == evaluation.count()
    assert frame.where(F.col("generated_title") == F.substring("inputs", 1, 10)).count() == frame.count()

    tables.save_table(frame, f"{db}.eval_frame")
    tables.save_table(pairs.select("prompt", "response"), f"{db}.all_pairs")
    jsonl.table_to_jsonl(spark, f"{db}.all_pairs", str(tmp_path / "titles.jsonl"))
    assert len(Path(tmp_path / "titles.jsonl").read_text().splitlines()) == 142
