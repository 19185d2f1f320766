"""Benchmark decontamination: an FM-index per shard of documents, searched for test phrases."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.arrow_rows import add_columns
from pairloom.llm.fm_index import FMIndex
from pairloom.llm.scratch import keep
from pairloom.llm.text_words import LETTERS_LOWER, words_of

WINDOW = 13
#: Characters of test items searched for in one pass, so that what each task holds is bounded.
BLOCK_CHARS = 8 << 20

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


@dataclass(frozen=True)
class Phrases:
    """Distinct windows of words, with the items (by number) that hold each of them."""

    hashes: np.ndarray  # one row per window, aligned left
    lengths: np.ndarray
    item_first: np.ndarray
    item: np.ndarray
    ids: list


def phrases(items: list[tuple[object, bytes]], window: int = WINDOW) -> Phrases:
    """Every window of each item; an item of fewer words, but not none, is one window."""
    ids = sorted({i for i, _ in items})
    number = {x: k for k, x in enumerate(ids)}
    words = words_of([t for _, t in items], LETTERS_LOWER)
    held: dict[bytes, set[int]] = {}
    for k, (item, _) in enumerate(items):
        own = words.hash[words.first[k] : words.first[k + 1]]
        for at in range(max(len(own) - window, 0) + 1 if len(own) else 0):
            held.setdefault(own[at : at + window].tobytes(), set()).add(number[item])
    lengths = np.array([len(k) // 8 for k in held], dtype=np.int64)
    hashes = np.zeros((len(held), window), dtype=np.uint64)
    for k, raw in enumerate(held):
        hashes[k, : len(raw) // 8] = np.frombuffer(raw, dtype=np.uint64)
    first = np.cumsum([0, *map(len, held.values())])
    item = np.array([i for s in held.values() for i in sorted(s)], dtype=np.int64)
    return Phrases(hashes, lengths, first, item, ids)


def _shard_hits(texts: list[bytes | None], tests: Phrases) -> Iterator[list]:
    """Per document of one shard: number of words, merged spans hit, items found."""
    words = words_of(texts, LETTERS_LOWER)
    counts = np.diff(words.first)
    vocabulary, symbol = np.unique(words.hash, return_inverse=True)
    n_docs = len(texts)
    symbols = np.zeros(len(symbol) + n_docs, dtype=np.int64)
    symbols[np.arange(len(symbol)) + words.doc] = symbol + 1
    doc_at = words.first[:-1] + np.arange(n_docs)  # where each document begins in ``symbols``
    spans: list[list] = [[] for _ in range(n_docs)]
    found: list[list] = [[] for _ in range(n_docs)]
    if len(vocabulary) and len(tests.lengths):
        place = np.searchsorted(vocabulary, tests.hashes).clip(max=len(vocabulary) - 1)
        known = vocabulary[place] == tests.hashes
        patterns = np.where(known, place + 1, -1)
        index = FMIndex(symbols)
        low, high = index.search(patterns, tests.lengths)
        hits = high - low
        phrase = np.repeat(np.arange(len(hits)), hits)
        rows = np.arange(hits.sum()) - np.repeat(np.cumsum(hits) - hits, hits) + low[phrase]
        at = index.locate(rows)
        order = np.argsort(at, kind="stable")
        at, phrase = at[order], phrase[order]
        doc = np.searchsorted(doc_at, at, side="right") - 1
        start = at - doc_at[doc]
        end = start + tests.lengths[phrase]
        for lo, hi in _runs(doc):
            d = doc[lo]
            spans[d] = _merged(start[lo:hi], end[lo:hi])
            own = np.unique(phrase[lo:hi])
            items = {int(i) for p in own for i in tests.item[tests.item_first[p] : tests.item_first[p + 1]]}
            found[d] = [tests.ids[i] for i in sorted(items)]
    return counts, spans, found


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(values, prepend=-1, append=-1))
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def _merged(start: np.ndarray, end: np.ndarray) -> list[dict]:
    """Spans sorted by start, joined where they touch or overlap."""
    reach = np.maximum.accumulate(end)
    opens = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    closes = np.append(opens[1:], len(start)) - 1
    return [{"start": int(start[a]), "end": int(reach[b])} for a, b in zip(opens, closes)]


def find_hits(docs: DataFrame, benchmark: DataFrame, carry=None, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(row, n_words, spans, items)``: word spans of ``docs.text`` that repeat test phrases.

    A phrase is ``window`` consecutive words of an item (all its words, if fewer). Each task
    cuts its documents into shards of about 8 MB, indexes every word of a shard, and searches
    for all phrases; documents are never shuffled. Items come in blocks of ``block_chars``
    characters, one pass over the documents for each, so no task holds an unbounded test set.
    ``spans`` are merged, in words, with the end exclusive; ``items`` are distinct ids.

    Null or empty texts and texts without words have no spans. Items with a null id or text
    take no part, nor do items without words; repeated rows of either table count as often as
    they stand (documents) or once (items). Other columns of ``docs`` ride along in ``row``.
    """
    items = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = 1 + size // block_chars
    id_type = items.schema["item_id"].dataType
    arrow_id = pa.string() if isinstance(id_type, T.StringType) else pa.int64()
    if not isinstance(id_type, T.StringType):
        items, id_type = items.withColumn("item_id", F.col("item_id").cast("long")), T.LongType()
    sc = docs.sparkSession.sparkContext
    out = None
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        tests = sc.broadcast(phrases([(r.item_id, r.text.encode()) for r in own], window))
        columns = [
            ("n_words", T.LongType(), pa.int64()),
            ("spans", _SPANS, _ARROW_SPANS),
            ("items", T.ArrayType(id_type), pa.list_(arrow_id)),
        ]
        if out is None:
            if blocks > 1:
                carry = docs.columns
            out = add_columns(docs, lambda t, tests=tests: _shard_hits(t, tests.value), columns, carry)
        else:
            # The earlier blocks' finds ride along and are merged with this block's.
            out = keep(out, "hits").select("row", "row.text", "spans", "items")
            out = add_columns(out, lambda t, tests=tests: _shard_hits(t, tests.value), columns, ["row", "spans", "items"])
            before, now = F.col("row.spans"), F.col("spans")
            out = out.select("row.row", "n_words", _union(before, now).alias("spans"), F.array_union("row.items", "items").alias("items"))
    return out


def _union(a, b):
    """Two lists of spans as one merged list."""
    ordered = F.array_sort(F.concat(a, b))
    none = F.array().cast(_SPANS)

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["end"] < span["start"])
        return F.when(apart, F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))
        )

    return F.aggregate(ordered, none, add)


def n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated():
    """At least one word in twenty lies in a test phrase."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; all other rows and columns as they were."""
    return find_hits(docs, benchmark).where(~contaminated()).select("row.*")
