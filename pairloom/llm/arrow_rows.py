"""Columns computed from whole texts in Arrow batches, beside the row they belong to."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.text_words import groups


#: Where this package lies; workers on hosts that do not have it there need it installed.
ROOT = str(Path(__file__).resolve().parents[2])


def worker_path(spark: SparkSession) -> None:
    """Let workers of functions made from now on import this package."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *paths]))


def map_batches(df: DataFrame, run, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow``, by workers that can import this package.

    Functions go to the workers by name, so a worker loads tables and caches once and keeps
    them for all its tasks.
    """
    worker_path(df.sparkSession)
    return df.mapInArrow(run, schema)


def add_columns(
    docs: DataFrame,
    compute: Callable[[list[bytes | None]], Sequence[pa.Array]],
    own: list[tuple[str, T.DataType, pa.DataType]],
    carry: Sequence[str] | None = None,
    text: str = "text",
) -> DataFrame:
    """``(row, own columns...)``, where ``row`` is a struct of the columns in ``carry`` (all).

    ``compute`` gets the UTF-8 texts of some rows (about 8 MB at a time, null as None) and
    returns one array for each own column. Names in ``docs`` cannot clash with own ones. Rows
    stay where they are: nothing is shuffled.
    """
    carry = docs.columns if carry is None else list(carry)
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    inside = text in carry
    frame = docs.select(row) if inside else docs.select(row, F.col(text).alias("text"))
    schema = T.StructType([frame.schema["row"], *[T.StructField(n, t) for n, t, _ in own]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            texts = rows.field(carry.index(text)) if inside else batch.column("text")
            if rows.offset:
                texts = rows.flatten()[carry.index(text)] if inside else texts
            for low, high, held in groups(pa.record_batch([texts], ["text"])):
                made = [pa.array(a, type=t) for a, (_, _, t) in zip(compute(held), own)]
                yield pa.record_batch(
                    [rows.slice(low, high - low), *made], ["row", *[n for n, _, _ in own]]
                )

    return map_batches(frame, run, schema)
