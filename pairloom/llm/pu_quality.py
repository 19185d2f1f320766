"""Quality classifier by positive-unlabelled learning with a non-negative risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.arrow_rows import add_columns, map_batches
from pairloom.llm.scratch import keep, remove
from pairloom.llm.text_words import SPACED, mix, words_of

#: Score from which a document counts as good.
CUT = 0.7
#: Words per window in which repetition is measured.
WINDOW = 64
#: Characters of evidence that a share needs to count fully.
DAMPING = 40
#: Weight of the squared weights in the risk, and of the squared bias.
DECAY = 0.1
#: Rounds of the fit at most, the change of weights that ends it, and the length of a step at most.
ROUNDS, STILL, REACH = 40, 1e-4, 2.0

#: Bytes whose shares are features.
_GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", bytes(range(128, 256)), b"0123456789",
           b" ", b"\n", b".", b",", b"!?", b"|", b"#$%&*", b"'\"()-:;", b"<>{}[]/\\=_+@^~`"]
_TABLE = np.zeros((256, len(_GROUPS)))
for _k, _group in enumerate(_GROUPS):
    _TABLE[np.frombuffer(_group, dtype=np.uint8), _k] = 1


def features(texts: list[bytes | None]) -> np.ndarray:
    """Shares of kinds of characters, repetition of words and lines, lengths of both."""
    words = words_of(texts, SPACED)
    counts = np.diff(words.first)
    place = np.arange(len(words.hash)) - words.first[:-1][words.doc]
    windows = -(-counts // WINDOW)
    begins = np.cumsum(windows) - windows
    window = begins[words.doc] + place // WINDOW
    _, first = np.unique(words.hash ^ mix(window.astype(np.uint64)), return_index=True)
    distinct = np.bincount(window[first], minlength=int(windows.sum()))
    fresh = np.bincount(words.doc[first], minlength=len(texts)) / np.maximum(counts, 1)
    out = np.zeros((len(texts), len(_GROUPS) + 5))
    for k, text in enumerate(texts):
        text = text or b""
        n = len(text)
        out[k, : len(_GROUPS)] = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ _TABLE / (n + DAMPING)
        lines = [line for line in text.split(b"\n") if line]
        weight = n / (n + DAMPING)
        own = distinct[begins[k] : begins[k] + windows[k]]
        out[k, len(_GROUPS) :] = (
            weight * (1 - fresh[k]) if counts[k] else 0,
            weight * (1 - own.min() / min(WINDOW, counts[k])) if len(own) == 1 else 0,
            weight * (1 - len(set(lines)) / len(lines)) if lines else 0,
            np.log1p(n / max(counts[k], 1)),
            np.log1p(n / max(len(lines), 1)),
        )
    return out


@dataclass(frozen=True)
class Model:
    """A linear score over standardised features, their sizes and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def wide(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, np.abs(z), z**2 / 6], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        # Row by row, so that a text's score does not depend on the rows it stands with.
        total = (self.wide(x) * self.weights).sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def moments(x: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """Number, sums and sums of squares of the rows."""
    return np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)])


def standard(sums: np.ndarray) -> Model:
    """A model without weights yet, from the ``moments`` of all rows."""
    first, second = np.split(sums[1:] / sums[0], 2)
    spread = np.sqrt(np.maximum(second - first**2, 0)) + 1e-3
    # Rounded, so that sums taken in another order give the same model.
    return Model(first.round(7), spread.round(7), np.zeros(3 * len(first)), 0.0)


def risk_sums(model: Model, x: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """What one round of the fit needs of some rows; sums of several groups of rows add up.

    Of all rows: number, loss as negatives, its slope and its curvature. Of the trusted rows:
    number, loss as negatives, its slope, and the sum of the rows.
    """
    w = np.append(model.weights, model.bias)
    out = []
    for some in (x, x[trusted]):
        z = np.concatenate([model.wide(some), np.ones((len(some), 1))], axis=1)
        f = z @ w
        up = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        out += [[len(some), np.logaddexp(0, f).sum()], up @ z]
        out.append(z.sum(axis=0) if some is not x else ((z * (up * (1 - up))[:, None]).T @ z).ravel())
    return np.concatenate(out)


def fit(model: Model, total, prior: float) -> Model:
    """Minimise ``prior * E+[l(f)] + max(0, Eu[l(-f)] - prior * E+[l(-f)])``, ``l`` logistic.

    ``total(model)`` gives the ``risk_sums`` over all rows, so a round reads all of them. A round
    is one Newton step: as ``l(f) - l(-f) = -f``, the risk is convex while the estimate of the
    negative risk is not negative. Where it is, the step goes up in that part alone, so that the
    scorer does not fit the positives at its cost; each change of sign halves the steps.
    """
    d = len(model.weights) + 1
    w = np.append(model.weights, np.log(prior / (1 - prior)))
    length, sign = 1.0, True
    for _ in range(ROUNDS):
        sums = total(Model(model.mean, model.scale, w[:-1], float(w[-1])))
        (n, loss_u), slope_u, bend, (m, loss_p), slope_p, rows_p = np.split(sums, np.cumsum([2, d, d * d, 2, d]))
        slope_u, slope_p, mean_p = slope_u / n, slope_p / m, rows_p / m
        bend = bend.reshape(d, d) / n + DECAY * np.eye(d)
        whole = loss_u / n - prior * loss_p / m >= 0
        slope = slope_u - prior * mean_p + DECAY * w if whole else prior * slope_p - slope_u
        length, sign = (length if whole == sign else length / 2), whole
        move = length * np.linalg.solve(bend, slope)
        move *= min(1.0, REACH / max(1e-12, 2 * float(np.sqrt(move @ bend @ move))))
        w = w - move
        if np.abs(move).max() < STILL:
            break
    w = w.round(4)
    return Model(model.mean, model.scale, w[:-1], float(w[-1]))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_VECTOR = [("vector", T.ArrayType(T.DoubleType()), pa.list_(pa.float64()))]


def _total(rows: DataFrame, measure) -> np.ndarray:
    """The sum of ``measure(vectors, trusted)`` over all rows of ``(vector, trusted)``.

    Each task adds up its own rows; its sums are added by Spark, place by place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
                own = measure(x, batch.column("trusted").to_numpy(zero_copy_only=False))
                sums = own if sums is None else sums + own
        if sums is not None:
            yield pa.record_batch([np.arange(len(sums), dtype=np.int32), sums], ["place", "value"])

    sums = map_batches(rows, run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    return np.array([r.value for r in sums.orderBy("place").collect()])


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from trusted positives and unlabelled documents; None without positives.

    Positives are all rows of documents labelled 1 (and never 0) outside the held-out ones, and
    all rows count as unlabelled, held-out ones too, since no label of theirs is read. The class
    prior is the share of good ones among the rows labelled outside the held-out ones, so copies
    weigh in it as they do in the risk; it is taken for 0.01 at least and 0.99 at most, as the
    risk is not defined at 0 or 1. Features are computed once and written; a round of the fit
    reads them and sends one row per sum to the driver, about 3,200 whatever the number of documents.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    vectors = add_columns(docs, lambda texts: [list(features(texts))], _VECTOR, ["doc_id"])
    rows = keep(vectors.select("row.doc_id", "vector").join(known, "doc_id", "left").drop("doc_id"), "quality-features")
    share = rows.agg(F.count("quality").alias("n"), F.sum("quality").alias("good")).first()
    model = None
    if share.good:
        prior = min(0.99, max(0.01, share.good / share.n))
        seen = rows.select("vector", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("trusted"))
        model = fit(standard(_total(seen, moments)), lambda at: _total(seen, partial(risk_sums, at)), prior)
    remove(docs.sparkSession, rows)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, carry=None) -> DataFrame:
    """``(row, score)``: how likely each whole text would be labelled good, from 0 to 1.

    Texts alone are scored. A null text scores like an empty one; repeated rows score alike;
    other columns ride along in ``row``. Without any trusted positive there is nothing to learn
    and every score is 1. No text is shuffled; features move once where the labels are too many
    for a broadcast join by Spark's own measure.
    """
    model = train(docs, labels)

    def compute(texts: list[bytes | None]):
        return [model.score(features(texts)) if model else np.ones(len(texts))]

    return add_columns(docs, compute, [("score", T.DoubleType(), pa.float64())], carry)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that score below ``CUT``."""
    return score_quality(docs, labels).where(F.col("score") >= CUT).select("row.*")
