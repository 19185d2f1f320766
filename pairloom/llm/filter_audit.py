"""Filter interaction audit: which filters remove what, in every order of them.

Each text is read once for its flags. A counting Bloom filter over 64-bit codes of the texts
then tells which texts are alone for certain; only the rest is shuffled as full text, for the
smallest id of each. What the report needs are counts per set of failed filters, which add up.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.arrow_rows import add_columns, map_batches
from pairloom.llm.scratch import keep
from pairloom.llm.text_words import mix

#: The filters by their letters; bit k of a mask is set where the k-th one fails.
FILTERS = "ABCDE"
_DUPLICATE = 1 << FILTERS.index("E")
MIN_WORDS = 200

#: Texts per block of the sketch (on average), counters per block and counters per text.
BLOCK_TEXTS, BLOCK_CELLS, CELLS = 1 << 16, 1 << 20, 4
#: Codes that a task counts before it hands on what it has.
LOCAL_CODES = 1 << 20

_UPPER = bytes(range(65, 91))
_CONTINUATION = bytes(range(0x80, 0xC0))
_MARKS = b"#$%&*|"


def text_mask(text: bytes | None) -> int:
    """Bits of the filters that one text fails by itself (A to D; null is empty)."""
    text = text or b""
    words = text.split()  # of bytes: at \x20 and \x09-\x0D
    n_points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, _CONTINUATION)))
    n_upper = len(text) - len(text.translate(None, _UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * n_upper > 3 * n_points) << 2
        | any(m in text for m in _MARKS) << 3
    )


def text_code(text: Column, bits: int = 64) -> Column:
    """``bits`` of a 64-bit hash of a text, null as empty."""
    code = F.xxhash64(F.coalesce(text, F.lit("")))
    return code if bits == 64 else F.shiftrightunsigned(code, 64 - bits)


def _local_counts(n_blocks: int):
    """A task's counters as ``(block, kind, payload)``: kind 0 are counters, kind 1 codes."""

    def packed(codes: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(codes), return_counts=True)
        block, cells = places(values, n_blocks)
        order = np.argsort(block, kind="stable")
        values, counts, block, cells = values[order], counts[order], block[order], cells[order]
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        rows: list[tuple[int, int, bytes]] = []
        for low, high in zip(cuts, [*cuts[1:], len(block)]):
            # The low bit of a counter's entry says that it stands at two or more.
            own, n = np.unique(cells[low:high], return_counts=True)
            many = np.unique(cells[low:high][counts[low:high] > 1])
            twice = (n > 1) | np.isin(own, many)
            rows.append((int(block[low]), 0, (own.astype("<i4") * 2 + twice).astype("<i4").tobytes()))
            rows.append((int(block[low]), 1, values[low:high].tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32(), pa.binary()])], ["block", "kind", "payload"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            codes = batch.column("code").to_numpy(zero_copy_only=False)
            held.append(codes)
            size += len(codes)
            if size >= LOCAL_CODES:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    return run


def places(codes: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each code and its counters there, one row per code."""
    spread = mix(codes.view(np.uint64))
    block = (spread % np.uint64(n_blocks)).astype(np.int64)
    steps = np.arange(1, CELLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return block, (mix(spread[:, None] + steps[None, :]) % np.uint64(BLOCK_CELLS)).astype(np.int64)


def _merged(n_blocks: int):
    """Codes that may occur twice: per block first all counters are added, then codes looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, counters = -1, np.zeros(BLOCK_CELLS, dtype=np.uint8)
        for batch in batches:
            for block, kind, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "payload"))):
                if block != at:
                    at = block
                    counters[:] = 0
                if kind == 0:
                    entries = np.frombuffer(payload, dtype="<i4")
                    cells = entries >> 1  # each once in a row
                    counters[cells] = np.minimum(counters[cells] + 1 + (entries & 1), 2)
                else:
                    codes = np.frombuffer(payload, dtype="<i8")
                    found = codes[(counters[places(codes, n_blocks)[1]] > 1).all(axis=1)]
                    yield pa.record_batch([pa.array(found, pa.int64())], ["code"])

    return run


def possible_repeats(codes: DataFrame, n_rows: int) -> DataFrame:
    """``(code)``: distinct codes of ``codes (code long)`` that may occur more than once.

    A counting Bloom filter in blocks; their number follows ``n_rows``, so its load does not.
    Tasks count what they hold, so a code of a third of all rows arrives once per task. A code
    that is left out occurs once for certain; of those that occur once, about one in 400 stays.
    """
    n_blocks = max(1, -(-n_rows // BLOCK_TEXTS))
    local = map_batches(codes.select("code"), _local_counts(n_blocks), "block long, kind int, payload binary")
    dealt = local.repartition("block").sortWithinPartitions("block", "kind")
    return map_batches(dealt, _merged(n_blocks), "code long").distinct()


def _masks(docs: DataFrame, carry: list[str]) -> DataFrame:
    rows = add_columns(
        docs, lambda texts: [pa.array([text_mask(t) for t in texts], pa.int32())],
        [("mask", T.IntegerType(), pa.int32())], carry,
    )
    return rows.select("row.*", "mask")


def failed_filters(docs: DataFrame, part: str = "lang", bits: int = 64) -> DataFrame:
    """``(doc_id, part, mask)`` for every row of ``docs``: which of the five filters it fails.

    A fails under 200 words, B where under half of the words are distinct, C where over 3 % of
    the code points are A-Z, D with any of ``#$%&*|``, E if a row with a smaller ``doc_id`` has
    the same text. Null texts are empty and equal; words are maximal runs without ASCII white
    space. Rows of one ``doc_id`` do not make each other duplicates. A null ``doc_id`` is neither
    smaller nor larger than another. ``part`` null becomes an empty string.

    Full texts are compared: rows whose 64-bit code is shared by different texts (``bits`` of it,
    for tests) are matched by text again.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"), text_code(F.col("text"), bits).alias("code"),
    )
    flags = keep(_masks(rows, ["doc_id", "part", "code"]), "flags")
    suspects = keep(possible_repeats(flags, flags.count()), "suspects")
    # Partial sums make one row of a task's copies before texts are shuffled.
    firsts = rows.join(suspects, "code", "left_semi").groupBy("code", "text").agg(F.min("doc_id").alias("first"))
    classes = keep(firsts.groupBy("code").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n_texts")), "classes")

    def mask() -> Column:
        return (F.col("mask") + F.when(F.col("doc_id") > F.col("first"), _DUPLICATE).otherwise(0)).alias("mask")

    found = flags.join(classes, "code", "left").where("coalesce(n_texts, 1) = 1").select("doc_id", "part", mask())
    clashes = classes.where("n_texts > 1").select("code")
    if clashes.isEmpty():
        return found
    mixed = rows.join(clashes, "code", "left_semi")
    least = mixed.groupBy("text").agg(F.min("doc_id").alias("first"))
    again = _masks(mixed.join(least, "text"), ["doc_id", "part", "first"])
    return found.unionByName(again.select("doc_id", "part", mask()))


def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, n_good, n_toxic)``: rows per set of failed filters; counts of parts add up.

    A row is good (toxic) if any row of ``labels (doc_id, quality, toxic)`` for its id has 1 there.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    rows = flags.join(marks, "doc_id", "left")
    return rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0).cast("long")).alias("n_good"),
        F.coalesce(F.sum("toxic"), F.lit(0).cast("long")).alias("n_toxic"),
    )


def order_report(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``mask_counts``; zeros included.

    A filter first in ``n! / k`` of all orders among the ``k`` that a row fails removes it there,
    which gives ``shapley`` without going through the orders.
    """
    orders = ["".join(p) for p in permutations(FILTERS)]
    cells = F.collect_list(F.struct("mask", "n", "n_good", "n_toxic"))
    rows = counts.groupBy("part").agg(cells.alias("cells")).select(
        "part", "cells", F.explode(F.split(F.lit(" ".join(orders)), " ")).alias("filter_order")
    ).select("*", F.explode(F.array(*[F.lit(k) for k in range(1, len(FILTERS) + 1)])).alias("step"))
    at = [F.instr("filter_order", f) for f in FILTERS]
    rows = rows.withColumns({
        "bit": sum(F.when(p == F.col("step"), 1 << k).otherwise(0) for k, p in enumerate(at)),
        "before": sum(F.when(p < F.col("step"), 1 << k).otherwise(0) for k, p in enumerate(at)),
    })

    def total(where, value="n") -> Column:
        one = value if callable(value) else lambda c: c[value]
        return F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.when(where(c["mask"]), one(c)).otherwise(0))

    bit, before = F.col("bit"), F.col("before")

    def fails(mask: Column) -> Column:
        return mask.bitwiseAND(bit) != 0

    def left(mask: Column) -> Column:
        return mask.bitwiseAND(before) == 0

    def removed(mask: Column) -> Column:
        return fails(mask) & left(mask)

    def share(c: Column) -> Column:
        return c["n"] * (F.lit(len(orders)) / F.greatest(F.bit_count(c["mask"]), F.lit(1))).cast("long")

    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: ~fails(m) & left(m)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: fails(m) & ~left(m)).alias("redundant"),
        total(lambda m: m == bit).alias("unique_fails"),
        total(removed, "n_good").alias("good_lost"),
        total(removed, "n_toxic").alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The report over all rows of ``docs``; an empty table has no parts, so no rows."""
    return order_report(keep(mask_counts(failed_filters(docs, part), labels), "mask-counts"))
