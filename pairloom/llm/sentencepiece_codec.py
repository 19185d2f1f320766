"""SentencePiece ids of whole texts, and texts of ids, by a table of each prefix's last token."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.arrow_rows import add_columns, map_batches
from pairloom.llm.piece_model import piece_model

_IDS = ("ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))
_DECODED = ("decoded", T.StringType(), pa.string())
#: Rows decoded at a time.
ROWS = 256


def _lists(made: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(m) // 4 for m in made)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(made), dtype="<i4")))


def _encoded(model: str, texts: list[bytes | None]) -> list[bytes]:
    return piece_model(model).encode([(t or b"").decode("utf-8", "replace") for t in texts])


def _decoded(model: str, made: list[bytes]) -> pa.Array:
    decode = piece_model(model).decode
    return pa.array([decode(np.frombuffer(m, dtype="<i4").tolist()) for m in made], pa.string())


def encode(docs: DataFrame, model: str, carry: Sequence[str] | None = None) -> DataFrame:
    """``(row, ids)``: the ids that the sentencepiece library gives each whole ``text``.

    ``model`` is the path of a model file on the workers. No begin or end ids, no sampling. A null
    or empty text has no ids; bytes that are no UTF-8 count as U+FFFD. ``row`` is a struct of the
    columns in ``carry`` (all of them), so no name can clash; repeated rows stay, and rows stay
    where they are. An empty table gives an empty result.
    """
    return add_columns(docs, lambda texts: [_lists(_encoded(model, texts))], [_IDS], carry)


def round_trip(docs: DataFrame, model: str, carry: Sequence[str] | None = None) -> DataFrame:
    """``(row, ids, decoded)``: as ``encode``, with the ids decoded again in the same pass."""

    def compute(texts: list[bytes | None]) -> list[pa.Array]:
        made = _encoded(model, texts)
        return [_lists(made), _decoded(model, made)]

    return add_columns(docs, compute, [_IDS, _DECODED], carry)


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``(row, decoded)``: the text that the library gives for each row's ``ids``.

    ``row`` holds all columns of ``encoded``. Null ids, as a list or in it, decode as if they were
    left out. Ids outside the model fail the job.
    """
    frame = encoded.select(
        F.struct(*[F.col(f"`{c}`") for c in encoded.columns]).alias("row"),
        F.filter(F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")), F.isnotnull).alias("ids"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = piece_model(model).decode
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [found(i) for i in part.column("ids").to_pylist()]
                yield pa.record_batch([part.column("row"), pa.array(texts, pa.string())], ["row", "decoded"])

    return map_batches(frame, run, T.StructType([frame.schema["row"], T.StructField("decoded", T.StringType())]))
