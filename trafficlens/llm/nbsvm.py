"""Quality classifier: Naive Bayes features under a linear SVM (operator 9).

Features are indicators of byte n-grams (1, 2 and 3 bytes; 3-grams are hashed)
and of hashed word n-grams (1 and 2 words). Each indicator is scaled by its
log-count ratio between the classes, a document's vector is scaled to length 1,
and a hinge-loss linear model is fitted by dual coordinate descent. A logistic
curve fitted on held-back margins turns a margin into a probability.

The fit uses at most ``max_train`` labelled rows (those with the smallest hash
of their id), whose features reach the driver as Arrow batches, two bytes for
each, and are unpacked a row at a time; the model has a fixed number of
dimensions. Scoring runs on every whole text, as an Arrow UDF on one column,
without any shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from .common import give_back, giving_back, ship, text_or_empty, text_slices

HASH_BITS = 18
# where the indices of 2- and 3-byte grams, words and pairs of words begin
ORDER2, ORDER3 = 256, 256 + 65536
WORDS = ORDER3 + (1 << HASH_BITS)
PAIRS = WORDS + (1 << HASH_BITS)
DIMS = PAIRS + (1 << HASH_BITS)
BLOCKS = (DIMS >> 16) + 1  # of 65,536 indices, for packed rows
_FIRST = np.arange(BLOCKS) << 16
SLICE = 1 << 20  # bytes of a text that are looked at together
_SHIFT = np.uint32(32 - HASH_BITS)
_SPACE = re.compile(rb"\s")

_stamp = None


def _distinct(codes: np.ndarray) -> np.ndarray:
    """Distinct codes without sorting: the last writer of a cell wins."""
    global _stamp
    if _stamp is None:
        _stamp = np.zeros(DIMS, np.int64)
    at = np.arange(len(codes))
    _stamp[codes] = at
    return codes[_stamp[codes] == at]


def _byte_grams(raw: bytes) -> Iterator[np.ndarray]:
    for start in range(0, len(raw), SLICE):
        first = max(0, start - 2)  # grams across the border of two slices
        b = np.frombuffer(raw, np.uint8, min(start + SLICE, len(raw)) - first, first).astype(np.uint32)
        yield _distinct(b.astype(np.int64))
        if len(b) > 1:
            two = (b[:-1] << np.uint32(8)) | b[1:]
            yield _distinct(two.astype(np.int64) + ORDER2)
        if len(b) > 2:
            three = ((two[:-1] << np.uint32(8)) | b[2:]) * np.uint32(0x9E3779B1)
            yield _distinct((three >> _SHIFT).astype(np.int64) + ORDER3)


def _word_grams(raw: bytes) -> Iterator[np.ndarray]:
    start, before = 0, np.zeros(0, np.uint32)
    while start < len(raw):
        space = _SPACE.search(raw, start + SLICE) if start + SLICE < len(raw) else None
        end = space.start() if space else len(raw)
        words = raw[start:end].split()
        start = end
        if not words:
            continue
        word = np.fromiter(map(crc32, words), np.uint32, len(words))
        yield _distinct((word >> _SHIFT).astype(np.int64) + WORDS)
        chain = np.concatenate([before, word])  # with the last word of the slice before
        pair = (chain[:-1] * np.uint32(0x9E3779B1) ^ chain[1:]) * np.uint32(0x85EBCA6B)
        yield _distinct((pair >> _SHIFT).astype(np.int64) + PAIRS)
        before = word[-1:]


def features(text: str) -> np.ndarray:
    """Distinct feature indices of a text, in no particular order. A text of
    any length is read in slices; what is held grows with ``SLICE``, not with
    the text, but for the bytes themselves."""
    raw = text.encode("utf-8", "replace")
    parts = [*_byte_grams(raw), *_word_grams(raw)]
    found = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return found if len(raw) <= SLICE else _distinct(found)


def pack(found: np.ndarray) -> bytes:
    """Sorted indices as the number of them in each block of 65,536, and then
    their places within the blocks: two bytes for each index."""
    counts = np.bincount(found >> 16, minlength=BLOCKS).astype(np.uint32)
    return counts.tobytes() + (found & 0xFFFF).astype(np.uint16).tobytes()


def unpack(packed) -> np.ndarray:
    """The indices from ``pack``; ``packed`` is any buffer."""
    found = np.repeat(_FIRST, np.frombuffer(packed, np.uint32, BLOCKS))
    found += np.frombuffer(packed, np.uint16, offset=4 * BLOCKS)
    return found


@dataclass
class PackedRows(Sequence):
    """Feature rows that stay packed; one is unpacked each time it is read."""

    packed: Sequence

    def __len__(self) -> int:
        return len(self.packed)

    def __getitem__(self, i: int) -> np.ndarray:
        return unpack(self.packed[i])


@dataclass
class SomeRows(Sequence):
    """Those of ``rows`` at the places ``at``."""

    rows: Sequence[np.ndarray]
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.at)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.rows[self.at[i]]


@dataclass
class NBSVM:
    """``margin = sum(weight[f]) / sqrt(sum(square[f])) + bias`` over a text's
    features; probability ``1 / (1 + exp(-(slope * margin + shift)))``."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        norm = float(self.square[found].sum()) if len(found) else 0.0
        return (float(self.weight[found].sum()) / norm**0.5 if norm > 0 else 0.0) + self.bias

    def probability(self, margin: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50))))


def log_count_ratios(rows: Sequence[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    pos, neg = np.full(DIMS, alpha), np.full(DIMS, alpha)
    for found, label in zip(rows, y):
        (pos if label else neg)[found] += 1
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    return np.log((pos / (n1 + 2 * alpha)) / (neg / (n0 + 2 * alpha)))


def dual_coordinate_descent(
    rows: Sequence[np.ndarray], y: np.ndarray, ratio: np.ndarray, c: float = 1.0, epochs: int = 15, seed: int = 7, tolerance: float = 1e-3
) -> tuple[np.ndarray, float, np.ndarray]:
    """Minimise ``(|w|^2 + bias^2) / 2 + c * sum(hinge)`` one dual variable at
    a time; returns w, bias and the dual variables. Rows are the scaled
    indicators with a constant 1 for the bias, so each has squared length 2."""
    w, bias, a = np.zeros(DIMS), 0.0, np.zeros(len(rows))
    # a row's values are its ratios over their length; only the lengths are kept
    norms = np.array([float(np.sqrt((ratio[found] ** 2).sum())) or 1.0 for found in rows])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in order.permutation(len(rows)):
            sign = 1.0 if y[i] else -1.0
            found = rows[i]
            v = ratio[found] / norms[i]
            gradient = sign * (w[found] @ v + bias) - 1.0
            new = min(max(a[i] - gradient / 2.0, 0.0), c)
            step = new - a[i]
            if step:
                a[i] = new
                w[found] += step * sign * v
                bias += step * sign
                largest = max(largest, abs(step))
        if largest < tolerance:
            break
    return w, bias, a


def logistic_curve(margins: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic fit by Newton steps; targets are smoothed
    as in Platt's method, so separable margins keep a finite slope."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0))
    x = np.stack([margins, np.ones(len(margins))], 1)
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, x.T @ (target - p) - 1e-6 * beta)
        beta += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def fit_rows(rows: Sequence[np.ndarray], y: np.ndarray, c: float = 1.0) -> NBSVM:
    """Fit on feature rows. With one class (or no row) alone there is nothing
    to separate: every score is the smoothed share of label 1."""
    y = np.asarray(y, np.int64)
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 1.0) / (len(y) + 2.0)
        return NBSVM(np.zeros(DIMS, np.float32), np.zeros(DIMS, np.float32), 0.0, 0.0, float(np.log(p / (1 - p))))
    fold = np.arange(len(y)) % 5 == 0
    margins, labels = [], []
    if 0 < y[~fold].sum() < (~fold).sum():
        held = _fit_once(SomeRows(rows, np.flatnonzero(~fold)), y[~fold], c)
        margins, labels = [held.margin(r) for r in SomeRows(rows, np.flatnonzero(fold))], y[fold]
    model = _fit_once(rows, y, c)
    if len(labels) == 0 or labels.min() == labels.max():
        margins, labels = [model.margin(r) for r in rows], y
    model.slope, model.shift = logistic_curve(np.array(margins), np.asarray(labels))
    return model


def _fit_once(rows: Sequence[np.ndarray], y: np.ndarray, c: float) -> NBSVM:
    ratio = log_count_ratios(rows, y)
    w, bias, _ = dual_coordinate_descent(rows, y, ratio, c)
    return NBSVM((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias, 1.0, 0.0)


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, max_train: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``id, label, features`` of the labelled documents used for the fit: the
    ``max_train`` smallest hashes of the usable labelled ids. An id with
    several labels has their majority (a draw is 1); null labels do not count.
    At most ``max_train`` (id, label) pairs are broadcast."""
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isNotNull())
        .groupBy("_id")
        .agg((F.avg("_y") >= 0.5).cast("int").alias("_y"))
        .where(usable)
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_train)
    )
    found = F.arrow_udf(_feature_column, returnType=BinaryType())
    return (
        docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
        .join(F.broadcast(chosen), "_id")
        .select("_id", "_y", found("_text").alias("_f"))
    )


def _feature_column(texts: pa.Array) -> pa.Array:
    return pa.array([np.sort(features(t)).astype(np.int32).tobytes() for t in texts.to_pylist()], pa.binary())


def _packed_column(found: pa.Array) -> pa.Array:
    return pa.array([pack(np.frombuffer(f.as_buffer(), np.int32)) for f in found], pa.binary())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out: Column | None = None,
    max_train: int = 8_000,
    c: float = 1.0,
) -> NBSVM:
    """Fit on labelled documents for which ``held_out`` (an expression on
    ``_id``) is false. An id on several document rows uses each of them, up to
    twice ``max_train`` rows."""
    ship(docs.sparkSession)
    usable = ~held_out if held_out is not None else F.lit(True)
    rows = training_rows(docs, labels, usable, max_train, id_col, text_col, label_col)
    packed = F.arrow_udf(_packed_column, returnType=BinaryType())
    rows = rows.select("_id", "_y", F.xxhash64("_id", "_f").alias("_order"), packed("_f").alias("_packed"))
    # Arrow buffers are read in place, with no Row for each; collect() would hold
    # the rows several times over, in the driver's JVM and in Python
    rows = rows.orderBy("_order", "_id").limit(2 * max_train).select("_y", "_packed").toArrow()
    try:
        return fit_rows(PackedRows([v.as_buffer() for v in rows["_packed"]]), rows["_y"].to_numpy(), c)
    finally:
        del rows
        give_back()


def scorer(df: DataFrame, model: NBSVM):
    """A function from a text column to its score (0 to 1)."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # DIMS floats, twice

    def score_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            yield pa.array([m.probability(m.margin(features(t))) for part in text_slices(texts) for t in part.to_pylist()], pa.float64())

    udf = F.arrow_udf(giving_back(score_column), returnType=DoubleType())
    return lambda col: udf(text_or_empty(col))


def crc_fold(col: str | Column, folds: int = 5) -> Column:
    """Fold of an id: crc32 of its text modulo ``folds``; null as empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % folds


def classify(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **fit_options
) -> DataFrame:
    """``<id_col>, held_out, score, predicted`` for every row of ``docs``.

    Rows of fold 0 of the id's crc32 are held out of the fit. Only the text is
    scored; null and empty texts score by the bias, texts of any length are
    read whole in slices. Rows that repeat an id or a text are scored each,
    alike. A score of exactly ``threshold`` predicts 1. Other columns are
    ignored, so they may have any name. Without a usable label every score is
    one half; an empty table gives no rows.
    """
    model = fit(docs, labels, label_col, id_col, text_col, crc_fold("_id") == 0, **fit_options)
    scored = docs.select(
        F.col(id_col), (crc_fold(id_col) == 0).alias("held_out"), scorer(docs, model)(text_col).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
