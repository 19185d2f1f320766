"""Batch inference that goes on where a lost job stopped."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.functions.hashing import digest, stable_hash
from pairloom.functions.model_calls import OnError, Retry
from pairloom.functions.payload import GenParams
from pairloom.operators.infer import ScorerFactory, batch_infer
from pairloom.sources.tables import ensure_dir, has_files, remove_dir

#: Columns of the stored answers beside the caller's own.
_KEY, _RUN, _FAILED = "_request", "_run", "_failed"
_CHUNK = "_chunk"


def request_key(key: Sequence[str], prompt_col: str, params: GenParams) -> Column:
    """What an answer belongs to: the row's key, its prompt and the settings, as one digest."""
    names = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(key)]
    asked = F.struct(*names, F.col(f"`{prompt_col}`").alias("prompt"), params.column().alias("params"))
    return digest(F.to_json(asked, {"ignoreNullFields": "false"}))


def stored_answers(spark: SparkSession, path: str) -> DataFrame | None:
    """All answers below ``path``, each request once: an answer before a failure, late before early."""
    if not has_files(spark, f"{path}/answers"):
        return None
    rows = spark.read.option("mergeSchema", "false").parquet(f"{path}/answers")
    good, failed = rows.where(~F.col(_FAILED)), rows.where(_FAILED)
    last = Window.partitionBy(_KEY).orderBy(F.col(_RUN).desc())
    failed = failed.join(good.select(_KEY), _KEY, "left_anti").withColumn("_n", F.row_number().over(last))
    return good.unionByName(failed.where("_n = 1").drop("_n"))


def infer_resumable(
    df: DataFrame,
    prompt_col: str,
    key: Sequence[str],
    factory: ScorerFactory,
    path: str,
    params: GenParams = GenParams(),
    out_col: str = "llm_response",
    error_col: str = "error",
    chunk_rows: int = 100_000,
    tasks: int | None = None,
    on_error: OnError = "null",
    call_size: int = 64,
    retry: Retry = Retry(),
    retry_errors: bool = False,
    run_col: str | None = None,
) -> DataFrame:
    """The rows of ``df`` with their answers, of which each is asked for once and then kept.

    Answers are appended below ``path`` in chunks of about ``chunk_rows`` rows, each a Spark job
    that commits as a whole. After a failure or a lost driver, the same call drops all rows whose
    answers are stored and calls the model for the rest alone; at most the chunk under way is
    asked for again. What counts as the same request is ``key``, prompt and ``params``: a prompt
    or a setting that has changed is asked again, and its old answer is left out of the result.
    ``key`` must tell rows apart; null is a value like others.

    A failed row is stored with its error. ``retry_errors`` asks for such rows again; whatever
    the latest run says of them holds. ``run_col`` adds the number of the run, from 1, that
    answered each row.

    Keys are compared as 32-byte digests. What is to be asked is written once, dealt by chunk, so
    that no chunk scans ``df`` again; that copy goes when the run ends. ``df`` must give the same
    rows each time it is read. Two runs at a time on one ``path`` would ask some rows twice.
    """
    spark = df.sparkSession
    asked = df.withColumn(_KEY, request_key(key, prompt_col, params))
    pending, run = asked, 1
    if has_files(spark, f"{path}/answers"):
        held = spark.read.parquet(f"{path}/answers")
        run = 1 + held.agg(F.coalesce(F.max(_RUN), F.lit(0))).first()[0]
        done = held.where(~F.col(_FAILED)) if retry_errors else held
        pending = asked.join(done.select(_KEY), _KEY, "left_anti")
    n_rows = pending.count()
    n_chunks = -(-n_rows // chunk_rows)
    if n_chunks:
        waiting = f"{path}/waiting-{uuid.uuid4().hex[:12]}"
        ensure_dir(spark, path)
        # Rows of a chunk go to files of about equal size, whatever their keys.
        chunk = (stable_hash(run, [F.hex(_KEY)], digits=15) % n_chunks).cast("int")
        dealt = pending.withColumn(_CHUNK, chunk)
        if n_chunks > 1:
            dealt = dealt.repartition(_CHUNK, F.pmod(F.xxhash64(_KEY), F.lit(tasks or spark.sparkContext.defaultParallelism)))
        try:
            dealt.write.partitionBy(_CHUNK).parquet(waiting)
            stored = spark.read.schema(dealt.schema).parquet(waiting)
            for k in range(n_chunks):
                rows = stored.where(F.col(_CHUNK) == k).drop(_CHUNK)
                answered = batch_infer(
                    rows, prompt_col, factory, params, out_col, error_col, on_error, call_size, tasks, retry
                )
                answered.withColumns({_RUN: F.lit(run), _FAILED: F.col(error_col).isNotNull()}).write.mode(
                    "append"
                ).parquet(f"{path}/answers")
        finally:
            remove_dir(spark, waiting)
    found = stored_answers(spark, path)
    if found is None:  # nothing was asked, now or before
        nothing = F.lit(None).cast("string")
        extra = {run_col: F.lit(None).cast("int")} if run_col else {}
        return df.limit(0).withColumns({out_col: nothing, error_col: nothing, **extra})
    # Answers to requests that ``df`` no longer makes stay stored, and out of the result.
    found = found.join(asked.select(_KEY), _KEY, "left_semi")
    runs = {run_col: F.col(_RUN)} if run_col else {}
    return found.withColumns(runs).select(*df.columns, out_col, error_col, *runs)
