"""Prefix trie of conversations: shared beginnings, with sums over all that follows them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.arrow_rows import map_batches
from pairloom.llm.scratch import keep
from pairloom.llm.tree_totals import subtree_totals

#: Turns per block when running sums are taken.
BLOCK_TURNS = 256
#: Bytes of joined ids that one row holds before they are hashed.
PIECE_BYTES = 1 << 20
#: A word (fixed value of the contract).
WORD = r"[^\x20\x09-\x0D]+"

_PARTS = ["p0", "p1", "p2", "p3"]
#: A prefix: its number of turns and 128 bits of hash.
PREFIX = ["depth", *_PARTS]


def _zero() -> Column:
    return F.lit(0).cast("long")


def _long(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("long")


def _at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running number of each row among those of its conversation in this sorted partition."""
    part, last, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
        if not len(conv):
            continue
        starts = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1))
        at = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
        first = int(starts[1]) if len(starts) > 1 else len(conv)
        if last is not None and conv[0] == last:
            at[:first] += n
        last, n = conv[-1], int(at[-1]) + 1
        yield pa.record_batch(
            [batch.column("conv_id"), batch.column("digest"), batch.column("n_words"), np.full(len(conv), part, dtype=np.int64), at.astype(np.int64)],
            ["conv_id", "digest", "n_words", "part", "at"],
        )


def _earlier(rows: DataFrame, by: str, columns: list[str]) -> list[Column]:
    before = Window.partitionBy("conv_id").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return [F.coalesce(F.sum(c).over(before), _zero()).alias(f"before_{c}") for c in columns]


def placed_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, digest, n_words, n_turns)``: turns in order, without their texts.

    Order is by (turn, digest), null turns first; a digest stands for role and text, null as
    empty. Rows that are equal in all of these are interchangeable, and count each. The rows of
    one conversation are dealt by range and numbered in parts, so it may hold any share of them.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        _long("conv_id").alias("conv_id"), "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        _long(F.regexp_count(text, F.lit(WORD))).alias("n_words"),
        F.monotonically_increasing_id().alias("salt"),
    )
    order = ["conv_id", "turn", "digest", "salt"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = keep(
        map_batches(dealt, _at, "conv_id long, digest string, n_words long, part long, at long"), "placed"
    )
    parts = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select(
        "conv_id", "part", *_earlier(parts, "part", ["n"]), F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns")
    )
    return placed.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") + F.col("before_n") + 1).alias("place"), "digest", "n_words", "n_turns"
    )


def rebuild(placed: DataFrame, heads: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another one.

    ``heads (conv_id, base, head)`` gives every conversation that ``placed`` holds the
    conversation its first ``head`` turns (``longest`` at most) come from (all that there are,
    if fewer; none if absent); its own first ``head`` turns go. Returns the turns, as ``placed`` has them, and
    ``(conv_id, n_turns)`` of all conversations, also those left without turns. Heads are meant
    to be short: a base's head rows are copied to each conversation that takes them.
    """
    sizes = placed.where("place = 1").select("conv_id", "n_turns")
    whole = heads.join(sizes, "conv_id")
    whole = whole.join(sizes.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns")), "base", "left")
    copied = F.least("head", F.coalesce("base_turns", _zero()))
    convs = keep(whole.select(
        "conv_id", "base", "head", copied.alias("copied"),
        (F.greatest(F.col("n_turns") - F.col("head"), _zero()) + copied).alias("total"),
    ), "rebuilt")
    own = placed.join(convs, "conv_id").where("place > head").select(
        "conv_id", (F.col("place") - F.col("head") + F.col("copied")).alias("place"), "digest", "n_words", F.col("total").alias("n_turns")
    )
    first = placed.where(F.col("place") <= longest).select(F.col("conv_id").alias("base"), "place", "digest", "n_words")
    taken = convs.where("copied > 0").join(first, "base").where("place <= copied").select(
        "conv_id", "place", "digest", "n_words", F.col("total").alias("n_turns")
    )
    return own.unionByName(taken), convs.select("conv_id", F.col("total").alias("n_turns"))


def prefixes(placed: DataFrame) -> DataFrame:
    """``(conv_id, depth, p0..p3, q0..q3, n_words, n_turns)``: hash of the first ``depth`` turns.

    ``q`` is the hash without the last of them. It is a sum of 128-bit codes of (place, digest),
    taken in blocks of places and then over the blocks.
    """
    code = F.md5(F.concat_ws(":", F.col("place").cast("string"), "digest"))
    coded = keep(placed.select(
        "conv_id", "place", "n_words", "n_turns", F.floor((F.col("place") - 1) / BLOCK_TURNS).cast("long").alias("block"),
        *[_long(F.conv(F.substring(code, 1 + 8 * k, 8), 16, 10)).alias(p) for k, p in enumerate(_PARTS)],
    ), "turns")
    blocks = coded.groupBy("conv_id", "block").agg(*[F.sum(p).alias(p) for p in _PARTS])
    blocks = blocks.select("conv_id", "block", *_earlier(blocks, "block", _PARTS))
    running = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = coded.select("*", *[F.sum(p).over(running).alias(f"sum_{p}") for p in _PARTS]).join(blocks, ["conv_id", "block"])
    after = [F.col(f"before_{p}") + F.col(f"sum_{p}") for p in _PARTS]
    return sums.select(
        "conv_id", F.col("place").alias("depth"), *[a.alias(p) for a, p in zip(after, _PARTS)],
        *[(a - F.col(p)).alias(f"q{k}") for k, (a, p) in enumerate(zip(after, _PARTS))], "n_words", "n_turns",
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by prefix and id as ``(prefix, first id, ids joined)``, one per run or more."""
    key, first, held, size = None, 0, [], 0

    def row() -> pa.RecordBatch:
        columns = [pa.array([v], pa.int64()) for v in (*key, first)]
        return pa.record_batch([*columns, pa.array([",".join(held)])], [*PREFIX, "first", "ids"])

    for batch in batches:
        for *at, conv_id in zip(*(batch.column(c).to_pylist() for c in (*PREFIX, "conv_id"))):
            if held and (at != key or size >= PIECE_BYTES):
                yield row()
                held, size = [], 0
            if not held:
                key, first = at, conv_id
            held.append(str(conv_id))
            size += len(held[-1]) + 1
    if held:
        yield row()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by prefix and first id, each prefix's ids hashed one piece after another."""
    key, sha = None, hashlib.sha256()
    for batch in batches:
        done = []
        for *at, ids in zip(*(batch.column(c).to_pylist() for c in (*PREFIX, "ids"))):
            if at != key:
                if key:
                    done.append([*key, sha.hexdigest()])
                key, sha = at, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield _digests(done)
    if key:
        yield _digests([[*key, sha.hexdigest()]])


def _digests(rows: list[list]) -> pa.RecordBatch:
    *keys, shas = zip(*rows)
    return pa.record_batch([*[pa.array(k, pa.int64()) for k in keys], pa.array(shas)], [*PREFIX, "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """``(prefix, ends_sha256)`` of ``ends (conv_id, prefix)``: SHA-256 of the ids in order.

    Ids become text in tasks that hold a range of (prefix, id) each; only the hash itself, which
    has no parts, goes over one prefix's ids in one task, a piece of text at a time.
    """
    keys = ", ".join(f"{c} long" for c in PREFIX)
    order = [*PREFIX, "conv_id"]
    pieces = map_batches(
        ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order), _pieces, f"{keys}, first long, ids string"
    )
    return map_batches(
        pieces.repartition(*PREFIX).sortWithinPartitions(*PREFIX, "first"), _hashed, f"{keys}, ends_sha256 string"
    )


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of ``turns``, as ``placed_turns`` gives them.

    ``convs (conv_id, n_turns)`` lists all conversations; those without turns end at the root.
    A node is each distinct sequence of first ``depth`` turns, from the root at depth 0 on.
    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (root: null),
    ``n_convs``, ``n_children``, ``n_leaves`` (nodes without children in its subtree),
    ``saved_tokens`` (over its subtree: words of a node's last text, times members but one) and
    ``ends_sha256`` (ids of members that end there). Without conversations there is no root.
    """
    rows = keep(prefixes(turns), "prefixes")
    nodes = rows.groupBy(*PREFIX).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_words").alias("n_words"),
        *[F.min(f"q{k}").alias(f"q{k}") for k in range(4)],
    )
    zeros = [_zero().alias(c) for c in PREFIX]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *zeros, "conv_id", "n_convs", _zero().alias("n_words"), *[F.lit(None).cast("long").alias(f"q{k}") for k in range(4)]
    )
    nodes = keep(nodes.unionByName(root), "nodes")
    # The smallest member and the depth name a node.
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), *[F.col(p).alias(f"q{k}") for k, p in enumerate(_PARTS)], F.col("conv_id").alias("parent_conv_id")
    )
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), *[F.col(f"q{k}").alias(p) for k, p in enumerate(_PARTS)]
    ).agg(F.count(F.lit(1)).alias("n_children"))
    counted = keep(nodes.join(above, ["depth", "q0", "q1", "q2", "q3"], "left").join(children, PREFIX, "left").select(
        F.struct("conv_id", "depth").alias("node"), F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))).alias("parent"),
        "n_convs", "n_words", F.coalesce("n_children", _zero()).alias("n_children"), *_PARTS,
    ), "counted")
    totals = subtree_totals(
        counted.select(
            "node", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    )
    ends = end_digests(
        rows.where("depth = n_turns").select("conv_id", *PREFIX).unionByName(convs.where("n_turns = 0").select("conv_id", *zeros))
    )
    return counted.select("*", F.col("node.depth").alias("depth")).join(totals, "node").join(ends, PREFIX, "left").select(
        "node.conv_id", "depth", F.col("parent.conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def shared_heads(convs: DataFrame, every: int, most: int) -> DataFrame:
    """``(conv_id, base, head)``: the first crc32(id) mod ``most`` turns come from the id that
    ``every`` divides, rounding towards zero."""
    return convs.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % most).cast("long").alias("head"),
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """``trie`` of ``turns (conv_id, turn, role, text)`` rebuilt with ``shared_heads``.

    Rows without ``conv_id`` are left out; other columns are ignored; ids are read as long.
    """
    placed = keep(placed_turns(turns), "placed")
    rebuilt, convs = rebuild(placed, shared_heads(placed.where("place = 1"), 20, 4), longest=3)
    return trie(rebuilt, convs)
