"""Rows that a smaller set of keys may hold, told apart where they are, before wide rows are shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.arrow_rows import map_batches, worker_path
from pairloom.llm.text_words import mix

#: Bits for each key, and bits of the largest filter (8 MB): beyond that more rows pass it.
KEY_BITS, MOST_BITS = 16, 1 << 26
#: Bits of a block that one group makes.
BLOCK_BITS = 1 << 16


def may_be_in(keys: DataFrame, *columns: str):
    """A test of ``columns``, to be called with the same columns of other rows.

    It is true for all rows whose values ``keys`` holds, and for one in sixteen of the others at
    most; of more than four million keys for more of them. So it only thins rows for an exact
    join. The filter is a bitmap of 8 MB at most, whatever the tables; each key sets one bit.
    """
    spark = keys.sparkSession
    n = keys.count()
    bits = BLOCK_BITS
    while bits < min(KEY_BITS * n, MOST_BITS):
        bits *= 2

    def places(codes: pa.Array) -> np.ndarray:
        return (mix(codes.to_numpy(zero_copy_only=False).view(np.uint64)) % np.uint64(bits)).astype(np.int64)

    def placed(batches):
        for batch in batches:
            at = np.unique(places(batch.column("code")))
            yield pa.record_batch([at // BLOCK_BITS, at % BLOCK_BITS], ["block", "bit"])

    def packed(table: pa.Table) -> pa.Table:
        held = np.zeros(BLOCK_BITS, dtype=np.uint8)
        held[table.column("bit").to_numpy()] = 1
        return pa.table({"block": table.column("block")[:1], "held": pa.array([np.packbits(held).tobytes()], pa.binary())})

    found = map_batches(keys.select(F.xxhash64(*columns).alias("code")), placed, "block long, bit long").distinct()
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for row in found.groupBy("block").applyInArrow(packed, "block long, held binary").collect():
        start = row.block * BLOCK_BITS // 8
        bitmap[start : start + BLOCK_BITS // 8] = np.frombuffer(row.held, dtype=np.uint8)
    shared = spark.sparkContext.broadcast(bitmap)
    worker_path(spark)

    @F.arrow_udf("boolean")
    def test(codes: pa.Array) -> pa.Array:
        at = places(codes)
        return pa.array((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)

    def tested(*others: str | Column) -> Column:
        return test(F.xxhash64(*others))

    return tested
