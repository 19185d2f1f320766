"""Exact top-k search by tiles of matrix products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.arrow_rows import map_batches
from pairloom.llm.scratch import keep

#: Rows of a block of queries and of a shard; a tile is one of each.
QUERY_ROWS = 512
SHARD_ROWS = 4096
#: Shards that one row of tiles visits before its lists are merged.
GROUP_SHARDS = 16
#: Lists merged at each level of the tree.
FAN_IN = 16

_BLOCK = "block string, n long, ids binary, vectors binary"
_LIST = "query_id long, vec_id long, score long, part long"


def whole_vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, vector)`` with floor(scale * x) components; unusable vectors are left out.

    A vector that is null or empty, or holds a null, NaN or infinite component, or a component
    that does not fit a 64-bit integer, takes no part; nor does a row without an id.
    """
    x = F.col("embedding").cast("array<double>")
    fits = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 2.0**62 / scale))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    return table.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & fits).select("vec_id", whole.alias("vector"))


def _blocks(rows: int):
    """Rows of ``(vec_id, vector)`` packed into matrices of at most ``rows`` rows, one per width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        made = 0

        def block(width: int) -> pa.RecordBatch:
            nonlocal made
            some = held.pop(width)
            ids = np.array([i for i, _ in some], dtype=np.int64)
            matrix = np.stack([v for _, v in some])
            order = np.argsort(ids, kind="stable")
            made += 1
            name = f"{width}-{ids.min()}-{made}"
            return pa.record_batch(
                [[name], [width], [ids[order].tobytes()], [matrix[order].tobytes()]],
                schema=pa.schema([("block", pa.string()), ("n", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())]),
            )

        for batch in batches:
            vectors = batch.column("vector")
            flat, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.append(0, vectors.value_lengths().to_numpy(zero_copy_only=False)))
            for k, i in enumerate(batch.column("vec_id").to_pylist()):
                vector = flat[ends[k] : ends[k + 1]].astype(np.int64)
                some = held.setdefault(len(vector), [])
                some.append((i, vector))
                if len(some) == rows:
                    yield block(len(vector))
        for width in list(held):
            yield block(width)

    return run


def scores_of(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Integer inner products; floating-point products only where they are exact."""
    most = float(np.abs(queries.astype(np.float64)).max(initial=0)) * float(np.abs(shard.astype(np.float64)).max(initial=0))
    if most * queries.shape[1] < 2.0**52:
        return (queries.astype(np.float64) @ shard.astype(np.float64).T).astype(np.int64)
    exact = queries.astype(object) @ shard.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def tile_top(queries: np.ndarray, query_ids: np.ndarray, shard: np.ndarray, ids: np.ndarray, k: int):
    """The best ``k`` of one tile per query, ties to the smaller id (``ids`` ascend)."""
    score = scores_of(queries, shard)
    other = query_ids[:, None] != ids[None, :]
    score = np.where(other, score, -(2**63))
    take = min(k, len(ids))
    bound = np.partition(score, len(ids) - take, axis=1)[:, len(ids) - take][:, None]
    over = (score > bound) & other
    level = (score == bound) & other
    level &= np.cumsum(level, axis=1) <= np.maximum(k - over.sum(axis=1, keepdims=True), 0)
    row, column = np.nonzero(over | level)
    return row, ids[column], score[row, column]


def _merge(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int):
    order = np.lexsort((vec, -score.astype(object)) if len(score) and score.min() == -(2**63) else (vec, -score))
    order = order[np.argsort(query[order], kind="stable")]
    query, vec, score = query[order], vec[order], score[order]
    first = np.searchsorted(query, query)
    kept = np.arange(len(query)) - first < k
    return query[kept], vec[kept], score[kept]


def _tiles(k: int):
    """Products of the query block and shards in each row, merged over a run of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def lists(part, query, vec, score):
            return pa.record_batch([query, vec, score, np.full(len(query), part)], ["query_id", "vec_id", "score", "part"])

        for batch in batches:
            for r in batch.to_pylist():
                query_ids, ids = np.frombuffer(r["q_ids"], dtype=np.int64), np.frombuffer(r["ids"], dtype=np.int64)
                queries = np.frombuffer(r["q_vectors"], dtype=np.int64).reshape(len(query_ids), -1)
                shard = np.frombuffer(r["vectors"], dtype=np.int64).reshape(len(ids), -1)
                row, vec, score = tile_top(queries, query_ids, shard, ids, k)
                key, new = (r["q_block"], r["part"]), (query_ids[row], vec, score)
                if held and held[0] == key:
                    new = tuple(np.concatenate(p) for p in zip(held[1], new))
                elif held:
                    yield lists(held[0][1], *held[1])
                held = key, _merge(*new, k)
        if held:
            yield lists(held[0][1], *held[1])

    return run


def _fold(k: int):
    """The best ``k`` of the lists of each query; a partition holds all lists of a query and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def done():
            q, v, s = (np.array(c, dtype=np.int64) for c in zip(*held))
            q, v, s = _merge(q, v, s, k)
            return pa.record_batch([q, v, s, np.full(len(q), key[1])], ["query_id", "vec_id", "score", "part"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score", "part")]
            for q, v, s, p in zip(*columns):
                if key != (q, p):
                    if held:
                        yield done()
                    held, key = [], (q, p)
                held.append((q, v, s))
        if held:
            yield done()

    return run


def top_k(queries: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` best rows of ``table`` but itself.

    Both frames are ``(vec_id long, vector array<long>)``. Queries and rows are packed into
    blocks; every block of queries meets every shard in one tile, whose product is exact and of
    which ``k`` rows per query are kept. A query's lists are then merged 16 at a time until one
    is left. Neither side is broadcast: a block of queries is copied to groups of 16 shards,
    and each copy does 16 tiles. Vectors of another width than the query's are not compared.

    Ties go to the smaller id. Of queries with one id the
    least vector counts; it leaves out all rows of that id. Fewer rows than ``k`` give a shorter list, empty tables an empty result.
    """
    spark = table.sparkSession
    shards = keep(map_batches(table, _blocks(SHARD_ROWS), _BLOCK), "shards")
    blocks = keep(
        map_batches(queries.groupBy("vec_id").agg(F.min("vector").alias("vector")), _blocks(QUERY_ROWS), _BLOCK), "queries"
    ).toDF("q_block", "n", "q_ids", "q_vectors")
    groups = 1 + shards.count() // GROUP_SHARDS
    shards = shards.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)))
    spread = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    tiles = spread.join(shards, ["part", "n"]).repartition("q_block", "part").sortWithinPartitions("q_block", "part")
    lists = map_batches(tiles.select("q_block", "part", "q_ids", "q_vectors", "ids", "vectors"), _tiles(k), _LIST)
    while True:
        groups = -(-groups // FAN_IN)
        part = F.floor(F.col("part") / FAN_IN).cast("long")
        lists = lists.withColumn("part", part).repartition("query_id", "part").sortWithinPartitions("query_id", "part")
        lists = map_batches(lists, _fold(k), _LIST)
        if groups == 1:
            break
    best = lists.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score").cast("decimal(20,0)")).alias("s"), "vec_id", "score"))).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score"
    )
