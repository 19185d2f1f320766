"""Chat formatting: collapse cumulative snapshots of conversations, then render the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.scratch import keep

#: Turns per block: ranks and running sums are taken in blocks, and one rendered row holds one.
BLOCK_TURNS = 256
#: Rendered form of one turn (fixed values of a widely used chat markup).
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

_PARTS = ["h0", "h1", "h2", "h3"]


def _pieces(text: Column) -> list[Column]:
    """The 128 bits of an MD5 as four numbers below 2^32, so that sums do not overflow."""
    code = F.md5(text)
    return [F.conv(F.substring(code, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k}") for k in range(4)]


def _offsets(blocks: DataFrame, columns: list[str]) -> DataFrame:
    """Sums of ``columns`` over the earlier blocks of the same conversation."""
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0).cast("long")).alias(f"before_{c}") for c in columns]
    return blocks.select("conv_id", "block", *sums)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, digest, place, h0..h3)``: each turn's place and the hash up to there.

    The rolling hash adds a 128-bit code of (place, role, text) for each turn, so that it is a
    running sum. Sums are taken inside blocks of turn numbers and then over the blocks, so that
    a very long conversation spreads over tasks; texts are not shuffled, only their digests.
    """
    digest = F.md5(F.to_json(F.struct("role", "text")))
    rows = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), digest.alias("digest"),
        F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(2**62))).cast("long").alias("block"),
    ).distinct()
    counts = _offsets(rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")), ["n"])
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "digest")
    placed = rows.withColumn("place", F.row_number().over(inside).cast("long")).join(counts, ["conv_id", "block"])
    placed = placed.withColumn("place", F.col("place") + F.col("before_n"))
    coded = keep(placed.select(
        "conv_id", "turn", "role", "digest", "block", "place",
        *_pieces(F.concat_ws(":", F.col("place").cast("string"), "digest")),
    ), "turns")
    sums = coded.groupBy("conv_id", "block").agg(*[F.sum(p).alias(p) for p in _PARTS])
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    return coded.select(
        "conv_id", "turn", "digest", "block", "place", *[F.sum(p).over(running).alias(p) for p in _PARTS]
    ).join(_offsets(sums, _PARTS), ["conv_id", "block"]).select(
        "conv_id", "turn", "digest", "place", *[(F.col(p) + F.col(f"before_{p}")).alias(p) for p in _PARTS]
    )


def maximal(prefixes: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, copies)`` of conversations that prefix no longer one.

    Of equal conversations the one with the smallest id stays; ``copies`` counts them.
    """
    whole = prefixes.groupBy("conv_id").agg(
        F.max("place").alias("n_turns"), *[F.max_by(p, "place").alias(p) for p in _PARTS]
    )
    ends = whole.groupBy("n_turns", *_PARTS).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    proper = prefixes.join(whole.select("conv_id", "n_turns"), "conv_id").where("place < n_turns")
    proper = proper.select(F.col("place").alias("n_turns"), *_PARTS).distinct()
    return ends.join(proper, ["n_turns", *_PARTS], "left_anti").select("conv_id", "n_turns", "copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """``(conv_id, segment, n_turns, copies, rendered)``: maximal conversations as chat text.

    A conversation whose turns, in order, are the first turns of a longer one is a snapshot of
    it and goes; of equal ones the smallest ``conv_id`` stays. Turns are ordered by (turn, role,
    digest); the same (conv_id, turn, role, text) logged twice counts once. ``rendered`` holds
    256 turns at most: ``segment`` 0 is all of a usual conversation, and longer ones go on in
    segments 1, 2 and so on, so no row grows without bound.

    Rows without ``conv_id`` are left out. A null turn comes first; a null text renders as an
    empty one, a null role as ``unknown``; null and empty are different turns all the same.
    Other columns are ignored. An empty table gives an empty result.
    """
    prefixes = keep(prefix_hashes(turns), "prefixes")
    kept = keep(maximal(prefixes), "maximal")
    places = prefixes.join(kept, "conv_id").select(
        "conv_id", F.coalesce("turn", F.lit(-(2**62))).alias("at"), "digest", "place", "n_turns", "copies"
    )
    texts = turns.where("conv_id IS NOT NULL").select(
        "conv_id", F.coalesce("turn", F.lit(-(2**62))).alias("at"),
        F.md5(F.to_json(F.struct("role", "text"))).alias("digest"),
        F.concat(
            F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE)
        ).alias("piece"),
    ).join(kept.select("conv_id"), "conv_id", "left_semi")
    rows = texts.join(places, ["conv_id", "at", "digest"]).withColumn(
        "segment", F.floor((F.col("place") - 1) / BLOCK_TURNS).cast("int")
    )
    # Equal rows of one turn have one place; the set drops them.
    ordered = F.array_sort(F.collect_set(F.struct("place", "piece")))
    return rows.groupBy("conv_id", "segment").agg(
        F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"), ordered.alias("turns")
    ).select(
        "conv_id", "segment", "n_turns", "copies",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("rendered"),
    )
