"""Secret scans: fixed patterns, and a randomness battery under false-discovery control."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.arrow_rows import add_columns, map_batches

KINDS = ("assign", "access", "hex", "random")
#: Least length of a run that the battery judges.
LEAST = 20
#: Level at which each of the battery's tests rejects uniform randomness.
REJECT = 0.001
#: Share of ordinary text allowed among the runs reported.
FALSE_DISCOVERIES = 0.001
#: Bins of -log10(p) for the step-up threshold; the last takes everything beyond.
BINS, BIN_WIDTH = 4000, 0.05

_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Padding ends a run, so that the value of NAME=value is a run of its own.
_RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,6}" % LEAST)
#: What may join a value to names before and after it, by the alphabets that the value may have.
_JOINTS = [re.compile(r) for r in ("[^_-]+", "[^+/]+", "[^+/_-]+")]
_SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
_HINT = re.compile(r"(?i:passw|secret|token|api)", re.ASCII)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of assignments, access keys and hex runs."""
    out = []
    if _HINT.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _codes(alphabet: bytes) -> np.ndarray:
    table = np.full(256, -1, dtype=np.int64)
    table[np.frombuffer(alphabet, dtype=np.uint8)] = np.arange(len(alphabet))
    return table


_HEX_LOWER, _HEX_UPPER = _codes(b"0123456789abcdef"), _codes(b"0123456789ABCDEF")
_BASE32 = _codes(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
_BASE64, _BASE64_URL = _codes(_SYMBOLS[:64]), _codes(_SYMBOLS[:62] + b"-_")
#: Candidate encodings from the narrowest on: table of codes, alphabet size.
ENCODINGS = ((_HEX_LOWER, 16), (_HEX_UPPER, 16), (_BASE32, 32), (_BASE64, 64), (_BASE64_URL, 64))
#: Lower case, capitals, digits and joints, and the chance that one follows another in names, numbers and paths.
_KINDS_OF = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"+/-_"]
_KIND = np.zeros(256, dtype=np.int64)
for _number, _symbols in enumerate(_KINDS_OF):
    _KIND[np.frombuffer(_symbols, dtype=np.uint8)] = _number
_FOLLOWS = np.log([[0.85, 0.05, 0.05, 0.05], [0.3, 0.6, 0.05, 0.05], [0.1, 0.1, 0.7, 0.1], [0.4, 0.3, 0.2, 0.1]])


class TextModel:
    """Chances of ordinary text by the corpus's shares of symbols.

    Text is either symbols with these shares, or words, capitals, numbers and joints in turn,
    whose letters have their shares in either case; the likelier of the two counts.
    """

    def __init__(self, shares: np.ndarray):
        letters = shares[np.frombuffer(_KINDS_OF[0], dtype=np.uint8)] + shares[np.frombuffer(_KINDS_OF[1], dtype=np.uint8)]
        inside = np.ones(256)
        for symbols, weights in zip(_KINDS_OF, (letters, letters, np.ones(10), np.ones(4))):
            inside[np.frombuffer(symbols, dtype=np.uint8)] = (weights + 1e-9) / (weights + 1e-9).sum()
        self.single, self.inside = np.log(np.maximum(shares, 1e-12)), np.log(inside)

    def log_chance(self, body: np.ndarray) -> float:
        kinds = _KIND[body]
        in_turn = math.log(1 / 4) + _FOLLOWS[kinds[:-1], kinds[1:]].sum() + self.inside[body].sum()
        return float(max(self.single[body].sum(), in_turn))


@lru_cache(maxsize=4)
def _model_of(shares: bytes) -> TextModel:
    return TextModel(np.frombuffer(shares))


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared by the cube-root approximation."""
    k = 2 / (9 * df)
    return _upper_tail(((x / df) ** (1 / 3) - (1 - k)) / math.sqrt(k))


def _classes(codes: np.ndarray, size: int) -> np.ndarray:
    """Codes in eight classes of neighbours, so that short runs have fair expectations."""
    return codes * 8 // size


def battery(run: bytes, shares: np.ndarray) -> float | None:
    """How unlikely ordinary text is to look as random as ``run``; None if it is not random.

    The encoding is the narrowest alphabet that holds the run (a run of digits alone has none
    and is a number). Uniformity over eight classes of the alphabet, runs above and below its
    middle, and correlation of neighbours are tested; a rejection by any means that the run is
    not random. Else the result bounds the chance that text of this length is so much more
    likely as random output than as text (``TextModel`` of ``shares``): a likelihood ratio of
    ``r`` or more has at most the chance ``1 / r`` in text, whatever the length. The ratio is divided by the number of
    encodings, as one of them is chosen.
    """
    body = np.frombuffer(run.rstrip(b"="), dtype=np.uint8)
    n = len(body)
    if n < LEAST or run.isdigit():
        return None
    for table, size in ENCODINGS:
        codes = table[body]
        if codes.min() >= 0:
            break
    else:
        return None
    text_like = _model_of(shares.tobytes()).log_chance(body) + n * math.log(size) + math.log(len(ENCODINGS))
    if text_like >= 0:
        return None
    counts = np.bincount(_classes(codes, size), minlength=8)
    chi = float(((counts - n / 8) ** 2).sum() * 8 / n)
    if _chi_tail(chi, 7) < REJECT:
        return None
    high = codes >= size // 2
    ups = int(high.sum())
    if ups in (0, n):
        return None
    expected = 1 + 2 * ups * (n - ups) / n
    spread = (expected - 1) * (expected - 2) / (n - 1)
    turns = 1 + int((high[1:] != high[:-1]).sum())
    if spread <= 0 or 2 * _upper_tail(abs(turns - expected) / math.sqrt(spread)) < REJECT:
        return None
    centred = codes - codes.mean()
    serial = float((centred[1:] * centred[:-1]).sum() / (centred**2).sum())
    if 2 * _upper_tail(abs(serial) * math.sqrt(n)) < REJECT:
        return None
    return math.exp(text_like)


def symbol_counts(texts: list[bytes | None]) -> np.ndarray:
    """How often each symbol of the run alphabet occurs, by byte value."""
    data = np.frombuffer(b"".join(t or b"" for t in texts), dtype=np.uint8)
    counts = np.bincount(data, minlength=256)
    out = np.zeros(256, dtype=np.int64)
    used = np.frombuffer(_SYMBOLS, dtype=np.uint8)
    out[used] = counts[used]
    return out


def pieces(run: str) -> list[tuple[int, int]]:
    """Spans of ``LEAST`` symbols or more: the whole run, and what lies between its joints."""
    spans = {(0, len(run))} | {m.span() for joint in _JOINTS for m in joint.finditer(run)}
    return sorted((s, e) for s, e in spans if len(run[s:e].rstrip("=")) >= LEAST)


def judged(run: str, shares: np.ndarray, taken: Iterable[tuple[int, int]] = ()) -> list[tuple[int, int, float]]:
    """``(start, end, p)`` of the least likely of the run's random pieces clear of each other and of ``taken``.

    p is multiplied by the number of pieces that were tried.
    """
    spans = pieces(run)
    random = [(p, s - e, s, e) for s, e in spans if (p := battery(run[s:e].encode(), shares)) is not None]
    out: list[tuple[int, int, float]] = []
    for p, _, start, end in sorted(random):
        if all(e <= start or s >= end for s, e in [*taken, *((s, e) for s, e, _ in out)]):
            out.append((start, end, min(1.0, p * len(spans))))
    return out


def candidates(text: str, shares: np.ndarray, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, float]]:
    """``(start, end, p)`` of the pieces of runs, clear of ``taken``, that the battery takes for random."""
    for m in _RUN.finditer(text):
        at = m.start()
        for start, end, p in judged(m[0], shares, [(s - at, e - at) for s, e in taken if s < m.end() and e > at]):
            yield at + start, at + end, p


def _bin(p: float) -> int:
    return min(BINS - 1, int(-math.log10(max(p, 1e-300)) / BIN_WIDTH))


def corpus_shares(docs: DataFrame) -> np.ndarray:
    """Each symbol's share in all texts, ordinary text being nearly all of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, dtype=np.int64)
        for batch in batches:
            total += symbol_counts([v.as_py() for v in batch.column("text").cast(pa.large_binary())])
        seen = np.flatnonzero(total)
        yield pa.record_batch([seen, total[seen]], ["symbol", "n"])

    rows = map_batches(docs.select("text"), count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    shares = np.zeros(256)
    for r in rows.collect():  # at most one row per symbol of the alphabet
        shares[r.symbol] = r.n
    return shares / max(shares.sum(), 1)


def threshold(docs: DataFrame, shares: np.ndarray, level: float = FALSE_DISCOVERIES) -> int:
    """The least bin of p that the step-up rule accepts over all runs of all texts.

    Every run of ``LEAST`` or more symbols is a test, those the battery rejects with p = 1; a run
    with several random pieces is as many tests.
    Runs are counted in bins of log p, so the driver sees no more than ``BINS`` numbers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            for value in batch.column("text"):
                for m in _RUN.finditer(value.as_py() or ""):
                    for p in [p for _, _, p in judged(m[0], shares)] or [1.0]:
                        total[_bin(p)] += 1
        seen = np.flatnonzero(total)
        yield pa.record_batch([seen, total[seen]], ["bin", "n"])

    rows = map_batches(docs.select("text"), count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    total, found, least = sum(r.n for r in rows), 0, BINS
    for r in sorted(rows, key=lambda r: -r.bin):
        found += r.n
        # The bin's largest p stands for all of it, so the rule errs on the strict side.
        if 10 ** (-r.bin * BIN_WIDTH) <= level * found / total:
            least = r.bin
    return max(least, 1)


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def spans_of(text: str, shares: np.ndarray, least: int) -> list[dict]:
    """All spans of one text: the base ones, and random runs clear of them."""
    found = base_spans(text)
    for start, end, p in candidates(text, shares, [(s, e) for s, _, e in found]):
        if _bin(p) >= least:
            found.append((start, 3, end))
    return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(found)]


def find_secrets(docs: DataFrame, carry=None) -> DataFrame:
    """``(row, spans)``: secrets in every whole text, in code points, by start, then kind.

    Base kinds follow their patterns. Kind ``random`` adds runs of 20 or more symbols, or
    pieces of them between ``/``, ``+``, ``-`` or ``_``, that a battery of tests takes for random output in their encoding and that survive the step-up
    rule over the whole corpus, where a run's p-value bounds the chance of ordinary text of its
    length looking so. Symbol shares and the rule use all texts; only 256 counts and the bins
    reach the driver. Three passes over the texts, no shuffle of them.

    Null and empty texts have no spans; repeated rows are judged alike; other columns ride
    along in ``row``.
    """
    shares = corpus_shares(docs)
    least = threshold(docs, shares)

    def compute(texts: list[bytes | None]):
        return [[spans_of((t or b"").decode(), shares, least) for t in texts]]

    return add_columns(docs, compute, [("spans", T.ArrayType(_SPAN), pa.list_(_ARROW_SPAN))], carry)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each stretch of secrets in ``text`` replaced by ``mark``.

    Overlapping spans are one stretch. ``n_chars``, where there is one, follows the new text.
    A text without secrets, null included, is left as it is.
    """
    found = find_secrets(docs)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))

    def step(state, s):
        return F.when(s["end"] <= state["at"], state).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.when(s["start"] < state["at"], state["done"]).otherwise(
                    F.concat(state["done"], F.col("row.text").substr((state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")), F.lit(mark))
                ).alias("done"),
            )
        )

    end = F.aggregate("spans", start, step)
    clean = F.when(F.size("spans") == 0, F.col("row.text")).otherwise(
        F.concat(end["done"], F.col("row.text").substr((end["at"] + 1).cast("int"), F.length("row.text")))
    )
    out = found.withColumn("clean", clean)
    columns = [
        F.col("clean").alias(c) if c == "text"
        else F.when(F.size("spans") == 0, F.col(f"row.`{c}`")).otherwise(F.length("clean").cast("long")).alias(c) if c == "n_chars"
        else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return out.select(*columns)
