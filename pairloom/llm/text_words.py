"""Words of whole texts as numpy arrays, from UTF-8 bytes.

Every separator that the operators use is an ASCII byte, and every byte of a longer code
point is a word byte, so words can be cut from bytes and equal those cut from code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; a single word may be longer.
CHUNK = 1 << 20
#: Bytes of text per group of documents handed to an operator; one document may be longer.
GROUP_BYTES = 8 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_NGRAM = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all 64 bits (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One fixed 64-bit code per byte value.
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, CHUNK + 1)
_POWER_INVERSE = _powers(_BASE_INVERSE, CHUNK + 1)


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and whether A-Z count as a-z."""

    word_bytes: np.ndarray
    lower: bool


def _without(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: ``[^\x20\x09-\x0D]+``, as it stands or with A-Z in lower case.
SPACED = Alphabet(_without((0x20, 0x20), (0x09, 0x0D)), lower=False)
SPACED_LOWER = Alphabet(SPACED.word_bytes, lower=True)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z in lower case: letters, digits, non-ASCII.
LETTERS_LOWER = Alphabet(_without((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)), lower=True)

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@dataclass(frozen=True)
class Words:
    """The words of some documents in order: their document, byte span and hash."""

    data: bytes
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    #: First word of each document, with the number of all words at the end.
    first: np.ndarray
    #: First byte of each document in ``data``.
    base: np.ndarray


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of spans modulo 2^64, mixed with the span's length."""
    n = len(data)
    if n <= CHUNK:
        power, inverse = _POWER[:n], _POWER_INVERSE
    else:
        power, inverse = _powers(_BASE, n), _powers(_BASE_INVERSE, n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_CODES[data] * power, out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def words_of(texts: list[bytes | None], alphabet: Alphabet) -> Words:
    """All words of ``texts`` (null: none)."""
    texts = [t or b"" for t in texts]
    data = b"\n".join(texts) + b"\n"
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    base = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lengths + 1, out=base[1:])
    base = base[:-1]
    if alphabet.lower:
        data = data.translate(_LOWER)
    raw = np.frombuffer(data, dtype=np.uint8)
    starts, ends, hashes = [], [], []
    at = 0
    while at < len(raw):
        to = min(at + CHUNK, len(raw))
        inside = alphabet.word_bytes[raw[at:to]]
        if to < len(raw) and inside[-1]:
            gaps = np.flatnonzero(~inside)
            while not len(gaps):  # one word fills the chunk
                to = min(to + CHUNK, len(raw))
                inside = alphabet.word_bytes[raw[at:to]]
                gaps = np.flatnonzero(~inside)
            to = at + int(gaps[-1]) + 1
            inside = inside[: to - at]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        start, end = edges[0::2], edges[1::2]
        hashes.append(_hashes(raw[at:to], start, end))
        starts.append(start + at)
        ends.append(end + at)
        at = to
    none = np.zeros(0, dtype=np.int64)
    start = np.concatenate([none, *starts])
    end = np.concatenate([none, *ends])
    first = np.searchsorted(start, np.append(base, len(raw)))
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    value = np.concatenate([np.zeros(0, dtype=np.uint64), *hashes])
    return Words(data, doc, start, end, value, first, base)


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of ``n`` words inside one document."""
    count = len(words.hash) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(words.doc[:count] == words.doc[n - 1 :])
    value = words.hash[:count].copy()
    for k in range(1, n):
        value *= _NGRAM
        value += words.hash[k : k + count]
    return at, mix(value[at] + np.uint64(n))


def groups(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, list]]:
    """``(from, to, texts as bytes)``: runs of rows with about ``GROUP_BYTES`` of text."""
    texts = batch.column(column).cast(pa.large_binary())
    at, size, held = 0, 0, []
    for i, value in enumerate(texts):
        text = value.as_py()
        held.append(text)
        size += len(text or b"")
        if size >= GROUP_BYTES:
            yield at, i + 1, held
            at, size, held = i + 1, 0, []
    if held:
        yield at, len(texts), held
