"""Packing along a space-filling curve: neighbouring documents share sequences."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pairloom.llm.arrow_rows import map_batches
from pairloom.llm.scratch import keep
from pairloom.llm.text_words import mix
from pairloom.llm.token_ids import byte_bpe

LENGTH = 2048
END = 1
#: Width of the hashed vectors, dimensions of their projection, bits per dimension.
WIDTH, DIMENSIONS, BITS = 256, 3, 16


def _normal(n: int) -> np.ndarray:
    """Fixed values that look drawn from a normal distribution."""
    u = mix(np.arange(1, 2 * n + 1, dtype=np.uint64)).astype(np.float64) / 2.0**64
    return np.sqrt(-2 * np.log(u[:n] + 2.0**-65)) * np.cos(2 * math.pi * u[n:])


_PROJECTION = _normal(WIDTH * DIMENSIONS).reshape(WIDTH, DIMENSIONS)
_SLOT = (mix(np.arange(1 << 17, dtype=np.uint64)) % np.uint64(2 * WIDTH)).astype(np.int64)


def document_vector(ids: np.ndarray) -> np.ndarray:
    """Signed feature hashing of a document's ids, damped and scaled to length one."""
    counts = np.bincount(_SLOT[ids & 0x1FFFF], minlength=2 * WIDTH)
    vector = (counts[:WIDTH] - counts[WIDTH:]).astype(np.float64)
    vector = np.sign(vector) * np.sqrt(np.abs(vector))
    return vector / max(float(np.sqrt((vector**2).sum())), 1e-12)


def cells(vectors: np.ndarray) -> np.ndarray:
    """Projected vectors as whole coordinates, even over the cube for normal projections."""
    erf = np.vectorize(math.erf, otypes=[np.float64])
    share = 0.5 * (1 + erf(vectors @ _PROJECTION / math.sqrt(2)))
    return np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(cell: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each cell (rows of coordinates) along the Hilbert curve of its cube.

    From the top bit down, the lower bits are exchanged or inverted to undo the curve's turns;
    the interleaved Gray code of what is left is the place.
    """
    x = cell.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            set_here = (x[i] >> level) & 1 != 0
            swap = np.where(set_here, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_here, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> level) & 1 != 0, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def tokenised(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, curve, ids)``: ids with the end id, two bytes each where the file allows it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer).encode
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            ids, vectors = [], []
            for raw in encode(batch.column("text").to_pylist(), end):
                own = np.frombuffer(raw, dtype="<u4")
                vectors.append(document_vector(own.astype(np.int64)))
                ids.append(own.astype("<u2").tobytes() if int(own.max()) < 1 << 16 else b"\0" + raw)
            if ids:
                curve = hilbert_keys(cells(np.stack(vectors)))
                yield pa.record_batch([batch.column("doc_id"), curve, pa.array(ids, pa.binary())], ["doc_id", "curve", "ids"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("curve", T.LongType()), T.StructField("ids", T.BinaryType())])
    return map_batches(docs.select("doc_id", "text"), run, schema)


def unpacked(raw: bytes) -> np.ndarray:
    """Ids from two bytes each; an odd length marks four bytes each after a lead byte."""
    if len(raw) % 2:
        return np.frombuffer(raw[1:], dtype="<u4")
    return np.frombuffer(raw, dtype="<u2").astype("<u4")


def cut_points(n: int, filled: int, length: int) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of a document's pieces, the current sequence being ``filled``."""
    start = 0
    while start < n:
        size = min(n - start, length - filled)
        yield start, size
        start += size
        filled = (filled + size) % length


def tail_lengths(n: int) -> list[int]:
    """``n`` as a sum of powers of two, largest first: sequences that need no padding."""
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens, in order along the curve.

    A document's ids are those of the tokenizer file and the end id 1. Hashed vectors of the
    ids are projected to three dimensions and range-sorted by Hilbert key; each range packs its
    documents one after another and cuts them where a sequence is full. What a range has left
    at its end goes into sequences whose lengths are powers of two, so nothing is padded. Ties
    on the curve are ordered and split by ``doc_id``, so copies do not pile up in one task.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece, and
    ``ids`` (unsigned 32-bit, little-endian) if asked for. A null or empty text is the end id
    alone; repeated rows are packed as often as they stand; other columns are ignored; an
    empty table has no pieces. A task holds one document and one sequence's pieces.
    """
    table = keep(tokenised(docs, tokenizer), "tokens", "zstd")
    # The ids break ties of repeated or null doc_ids, so that a retried task packs alike.
    ordered = table.repartitionByRange("curve", "doc_id").sortWithinPartitions("curve", "doc_id", "ids")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    fields = [docs.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names[1:7]]]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        filled, held, done = 0, [], []

        def piece(doc_id, total, start, ids, at):
            raw = ids.tobytes()
            row = (doc_id, start, len(ids), zlib.crc32(raw), total, sequence, at)
            return (*row, raw) if with_ids else row

        kind = None

        def batch_of(rows):
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            types = [kind, *[pa.int64()] * 6, pa.binary()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids = unpacked(raw.as_py())
                for start, size in cut_points(len(ids), filled, length):
                    held.append((doc_id, len(ids), start, ids[start : start + size]))
                    filled += size
                    if filled == length:
                        at = 0
                        for d, n, s, own in held:
                            done.append(piece(d, n, s, own, at))
                            at += len(own)
                        sequence, filled, held = sequence + 1, 0, []
                if len(done) >= 5000:
                    yield batch_of(done)
                    done = []
        for size in tail_lengths(filled):
            at = 0
            while at < size:
                d, n, s, own = held.pop(0)
                done.append(piece(d, n, s, own[: size - at], at))
                if len(own) > size - at:
                    held.insert(0, (d, n, s + size - at, own[size - at :]))
                at += min(len(own), size - at)
            sequence += 1
        if done:
            yield batch_of(done)

    return map_batches(ordered, run, T.StructType(fields))
