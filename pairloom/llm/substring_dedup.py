"""Substring dedup: fixed-block anchors, probed by every rolling window, then exact repeats.

A window of 13 words holds a whole block of 7 words wherever it lies over blocks that do not
overlap. So if a window of one document stands in another, some 7-word block that begins at a
multiple of 7 in the one equals a rolling 7-word window of the other. Blocks (anchors) and
rolling windows (probes) meet by hash; only text around anchors that were hit is compared
further, by its 13-word windows, whose covered words join into maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.arrow_rows import map_batches
from pairloom.llm.scratch import keep, release, remove
from pairloom.llm.text_words import SPACED, groups, mix, ngrams, words_of

WINDOW = 13
BLOCK = 7
#: Entries of one bucket of a shuffle, on average.
BUCKET_ENTRIES = 1 << 22

_NOTHING = hashlib.sha256(b"").hexdigest()
_PACKED = "bucket long, n long, ids binary, docs binary, codes binary"
_NAMES = ["bucket", "n", "ids", "docs", "codes"]


def _squeezed(values: np.ndarray) -> bytes:
    """Values as compressed planes of bytes; a raw size leads."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _loosened(raw: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    data = pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T).view(kind).ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _shingle_bucket(value: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a hash, from bits that its low half does not show."""
    return (mix(value) >> np.uint64(32)) % np.uint64(buckets)


def _packed(doc_ids: np.ndarray, doc: np.ndarray, code: np.ndarray, mark: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """Distinct (code, document) entries per bucket; ``mark`` holds if it does for any of them."""
    ids, rank = np.unique(doc_ids, return_inverse=True)
    doc = rank[doc]
    order = np.lexsort((doc, code, bucket))
    doc, code, mark, bucket = doc[order], code[order], mark[order], bucket[order]
    first = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (code[1:] != code[:-1]) | (np.diff(bucket) != 0)))
    mark = np.maximum.reduceat(mark.astype(np.uint8), first)
    doc, code, bucket = doc[first], code[first], bucket[first]
    entry = (doc.astype(np.uint32) << 1) | mark
    edges = np.flatnonzero(np.append(True, np.diff(bucket) != 0))
    ends = np.append(edges[1:], len(bucket))
    own = _squeezed(_steps(ids))
    rows = [
        (int(bucket[a]), int(b - a), own, _squeezed(entry[a:b]), _squeezed(_steps(code[a:b])))
        for a, b in zip(edges.tolist(), ends.tolist())
    ]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _NAMES)


def _anchors(doc_ids: np.ndarray, texts: list, buckets: int):
    words = words_of(texts, SPACED)
    at, value = ngrams(words, BLOCK)
    doc = words.doc[at]
    aligned = (at - words.first[doc]) % BLOCK == 0
    low = (value & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return doc, low, aligned, _shingle_bucket(value, buckets).astype(np.int64)


def _emitted(texts: DataFrame, entries, buckets: int, columns: list[str]) -> DataFrame:
    """``entries`` of each group of documents, packed per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, held in groups(batch):
                part = batch.slice(low, high - low)
                doc_ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                extra = [part.column(c) for c in columns]
                doc, code, mark, bucket = entries(doc_ids, held, buckets, *extra)
                if len(doc):
                    yield _packed(doc_ids, doc, code, mark, bucket)

    return map_batches(texts.select("doc_id", "text", *columns), run, _PACKED)


def _judged(packed: DataFrame, buckets: int, kind: str, judge, wide: bool) -> DataFrame:
    """``(doc_id, codes)``: the entries that ``judge`` takes, one row per document.

    Buckets of codes hand their entries on in packed rows, one per group of documents, and each
    group's are then gathered per document.
    """

    def flush(bucket: int, held: list) -> pa.RecordBatch:
        docs, codes, marks = [], [], []
        for n, ids, entry, code in held:
            entry, ids = _loosened(entry, "u4"), np.cumsum(_loosened(ids, "i8"))
            docs.append(ids[entry >> 1])
            marks.append(entry & 1 != 0)
            codes.append(np.cumsum(_loosened(code, kind), dtype=kind))
        doc, code, mark = np.concatenate(docs), np.concatenate(codes), np.concatenate(marks)
        order = np.argsort(code, kind="stable")
        doc, code, mark = doc[order], code[order], mark[order]
        edges = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        sizes = np.diff(np.append(edges, len(code)))
        taken = judge(doc, mark, edges, sizes)
        doc, code = doc[taken], code[taken].astype(np.uint64)
        if not wide:
            code |= np.uint64(bucket) << np.uint64(32)
        group = (mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((doc, group))
        doc, code, group = doc[order], code[order], group[order]
        edges = np.flatnonzero(np.append(True, np.diff(group) != 0)) if len(group) else np.zeros(0, dtype=np.int64)
        parts = list(zip(edges.tolist(), np.append(edges[1:], len(group)).tolist()))
        columns = [pa.array([_squeezed(_steps(doc[a:b])) for a, b in parts], pa.binary()), pa.array([_squeezed(code[a:b]) for a, b in parts], pa.binary())]
        return pa.record_batch([pa.array(group[edges]), *columns], ["group", "docs", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != now and held:
                    yield flush(now, held)
                    held = []
                now = row["bucket"]
                held.append((row["n"], row["ids"], row["docs"], row["codes"]))
        if held:
            yield flush(now, held)

    def gather(held: list[dict]) -> Iterator[pa.RecordBatch]:
        doc = np.concatenate([np.cumsum(_loosened(h["docs"], "i8")) for h in held])
        code = np.concatenate([_loosened(h["codes"], "i8") for h in held])
        order = np.argsort(doc, kind="stable")
        doc, code = doc[order], code[order]
        first = np.flatnonzero(np.append(True, np.diff(doc) != 0))
        ends = np.append(first[1:], len(doc))
        for at in range(0, len(first), 1000):
            low, high = int(first[at]), int(ends[min(at + 1000, len(first)) - 1])
            offsets = np.append(first[at : at + 1000], high) - low
            lists = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(code[low:high]))
            yield pa.record_batch([pa.array(doc[first[at : at + 1000]]), lists], ["doc_id", "codes"])

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != now and held:
                    yield from gather(held)
                    held = []
                now = row["group"]
                held.append(row)
        if held:
            yield from gather(held)

    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    taken = map_batches(dealt, run, "group long, docs binary, codes binary")
    gathered = taken.repartition(buckets, "group").sortWithinPartitions("group")
    return map_batches(gathered, per_document, "doc_id long, codes array<long>")


def _hit(doc, anchor, edges, sizes):
    """Probes of an anchor in a smaller document, and anchors that a larger one probes."""
    most = np.iinfo(np.int64).max
    least = np.repeat(np.minimum.reduceat(np.where(anchor, doc, most), edges), sizes)
    last = np.repeat(np.maximum.reduceat(doc, edges), sizes)
    return (doc > least) | (anchor & (doc < last) & (least < most))


def _later(doc, mark, edges, sizes):
    """Windows that a smaller document holds as well."""
    return doc > np.repeat(np.minimum.reduceat(doc, edges), sizes)


def _found(values: np.ndarray, first: np.ndarray, lists: pa.Array) -> np.ndarray:
    """For values cut into documents at ``first``: those in their document's list."""
    out = np.zeros(len(values), dtype=bool)
    for k, own in enumerate(lists):
        if own.is_valid and len(own):
            wanted = np.sort(own.values.to_numpy(zero_copy_only=False).view(np.uint64))
            part = values[first[k] : first[k + 1]]
            place = np.searchsorted(wanted, part).clip(max=len(wanted) - 1)
            out[first[k] : first[k + 1]] = wanted[place] == part
    return out


def _windows(doc_ids: np.ndarray, texts: list, buckets: int, hits: pa.Array):
    """13-word windows around the anchors that were hit."""
    words = words_of(texts, SPACED)
    at, value = ngrams(words, BLOCK)
    code = (_shingle_bucket(value, buckets) << np.uint64(32)) | (value & np.uint64(0xFFFFFFFF))
    found = _found(code, np.searchsorted(at, words.first), hits)
    near = np.zeros(len(words.hash) + 1, dtype=np.int64)
    near[at[found] + 1] = 1
    near = np.cumsum(near)
    at, value = ngrams(words, WINDOW)
    inside = near[at + WINDOW - BLOCK + 1] > near[at]
    at, value = at[inside], value[inside]
    return words.doc[at], value, np.zeros(len(at), dtype=bool), _shingle_bucket(value, buckets).astype(np.int64)


def _removed(texts: list, lists: pa.Array) -> Iterator[tuple[str, int, str]]:
    """``(hash of all words, words removed, hash of the rest)`` of each text."""
    words = words_of(texts, SPACED)
    at, value = ngrams(words, WINDOW)
    found = at[_found(value, np.searchsorted(at, words.first), lists)]
    cover = np.zeros(len(words.hash) + 1, dtype=np.int64)
    cover[found] += 1
    np.subtract.at(cover, np.minimum(found + WINDOW, len(words.hash)), 1)
    gone = np.cumsum(cover[:-1]) > 0
    for k, text in enumerate(texts):
        own = (text or b"").split()
        drop = gone[words.first[k] : words.first[k + 1]]
        rest = b" ".join(w for w, d in zip(own, drop.tolist()) if not d)
        yield hashlib.sha256(b" ".join(own)).hexdigest(), int(drop.sum()), hashlib.sha256(rest).hexdigest()


def _summaries(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, sha)``: number and hash of all words of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sha = [], []
            for value in batch.column("text").cast(pa.large_binary()):
                own = (value.as_py() or b"").split()
                n.append(len(own))
                sha.append(hashlib.sha256(b" ".join(own)).hexdigest())
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "sha"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("sha", T.StringType())])
    return map_batches(docs.select("doc_id", "text"), run, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every row of ``docs (doc_id long, text)``.

    A word goes if a window of 13 words covers it whose words also stand, in that order, in a
    document with a smaller ``doc_id``; windows are judged on the input. Of documents with the
    same words the smallest stands for all, and the others, from 13 words on, lose every word.

    A null or empty text has no words. A row with a null ``doc_id`` loses nothing and takes
    nothing from others. Rows that share a ``doc_id`` are one document to others and take
    nothing from each other. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    summary = keep(_summaries(rows), "words")
    least = summary.where(f"n_words >= {WINDOW} AND doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("least"))
    texts = rows.join(least.select(F.col("least").alias("doc_id")).distinct(), "doc_id", "left_semi")
    total = summary.agg(F.sum("n_words").alias("n")).first().n or 0
    buckets = max(1, total // BUCKET_ENTRIES)

    packed = _emitted(texts, _anchors, buckets, [])
    hits = keep(_judged(packed, buckets, "u4", _hit, wide=False), "hits", "zstd")
    release(spark)
    lists = hits.withColumnRenamed("codes", "hits")
    near = keep(rows.join(lists, "doc_id"), "near", "zstd")
    remove(spark, hits)
    release(spark)

    packed = _emitted(near, _windows, buckets, ["hits"])
    later = keep(_judged(packed, buckets, "u8", _later, wide=True), "later", "zstd")
    release(spark)
    lists = later.withColumnRenamed("codes", "later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, held in groups(batch):
                part = batch.slice(low, high - low)
                sha, n, kept = zip(*_removed(held, part.column("later")))
                columns = [part.column("doc_id"), pa.array(sha), pa.array(n, pa.int64()), pa.array(kept)]
                yield pa.record_batch(columns, ["doc_id", "sha", "n", "kept"])

    cut = map_batches(near.select("doc_id", "text").join(lists, "doc_id"), run, "doc_id long, sha string, n long, kept string")
    cut = keep(cut.distinct(), "cut")
    remove(spark, near, later)
    copy = (F.col("n_words") >= WINDOW) & (F.col("doc_id") > F.col("least"))
    return summary.join(least, "sha", "left").join(cut, ["doc_id", "sha"], "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(_NOTHING)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )
