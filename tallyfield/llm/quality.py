"""A quality classifier after naive Bayes support vectors.

A text is the set of its n-grams over two views: words in lower case, and word shapes (letter case, digits and marks,
runs folded, with a mark where a word repeats the one before). Each indicator is scaled by the log ratio of its
smoothed shares of the two classes. A linear model is fitted on the scaled indicators by dual coordinate descent on the
hinge loss, and its margin is turned into a probability on rows set apart. Training takes a bounded sample of labelled
documents; scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from struct import pack
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from .common import SMALL_MEMO, id_remainder, map_rows, mixed, remember_only, slices

#: Indicators are hashed into so many buckets, so weights have a fixed size.
BUCKETS = 1 << 18
#: Expected number of labelled documents that the model is fitted on, at most.
FIT_ROWS = 16_000
SHAPE_ORDERS = (1, 2, 3)
WORD_ORDERS = (1,)
THRESHOLD = 0.7
#: Characters of a word; a longer run without white space is cut into consecutive pieces that are words each.
LONGEST, PART = 48, 4
_FOLD = re.compile(r"(.)\1+", re.DOTALL)


def _shape(word: str) -> str:
    kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return _FOLD.sub(r"\1", kinds)


def words_of(text: str | None) -> list[str]:
    """White-space separated words; every character of a long run is in one of its pieces."""
    words = (text or "").split()
    if words and max(map(len, words)) > LONGEST:
        words = [
            part
            for w in words
            for part in ([w] if len(w) <= LONGEST else [w[i : i + PART] for i in range(0, len(w), PART)])
        ]
    return words


class Views(dict):
    """Hashes of a word and of its shape, side by side as two 64-bit numbers, remembered up to a bound."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= SMALL_MEMO:
            self.clear()
        lower = xxhash.xxh3_64_intdigest(word.lower())
        self[word] = value = pack("<QQ", lower, xxhash.xxh3_64_intdigest(_shape(word), seed=1))
        return value


_VIEWS = Views()


def indicators(text: str | None, shape_orders=SHAPE_ORDERS, word_orders=WORD_ORDERS) -> np.ndarray:
    """The buckets of all n-grams of a whole text, sorted and distinct."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.int32)
    remember_only(_VIEWS)
    both = np.frombuffer(b"".join(map(_VIEWS.__getitem__, words)), "<u8").reshape(-1, 2)
    lower, shape = both[:, 0], both[:, 1].copy()
    shape[1:][lower[1:] == lower[:-1]] ^= np.uint64(0x5555555555555555)
    found = []
    for values, orders in ((shape, shape_orders), (lower, word_orders)):
        values = mixed(values)
        for n in orders:
            size = len(values) - n + 1
            if size <= 0:
                continue
            run = np.full(size, n, np.uint64)
            for i in range(n):
                run = mixed(run * np.uint64(31) + values[i : i + size])
            found.append(run & np.uint64(BUCKETS - 1))
    return np.unique(np.concatenate(found)).astype(np.int32)


class Classifier(NamedTuple):
    """Weight of each bucket (log ratio times linear weight), log ratios, bias and the sigmoid's slope and shift."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, buckets: np.ndarray) -> float:
        """Probability of the better class."""
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(buckets) + self.shift, -500, 500))))

    def margin(self, buckets: np.ndarray) -> float:
        norm = np.sqrt(np.square(self.ratios[buckets]).sum())
        return self.bias + (self.weights[buckets].sum() / norm if norm else 0.0)


def dual_coordinate_descent(
    rows: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, cost: np.ndarray, epochs: int = 12
) -> tuple[np.ndarray, float]:
    """Hinge-loss weights over buckets for rows scaled by ``ratios`` to length 1; the bias is a feature of value 1."""
    weights, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    scaled = []
    for row in rows:
        values = ratios[row]
        norm = np.sqrt(np.square(values).sum())
        scaled.append(values / norm if norm else values)
    square = np.array([1.0 + np.square(v).sum() for v in scaled])
    order = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (scaled[i] @ weights[rows[i]] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                weights[rows[i]] += step * scaled[i]
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights, bias


def sigmoid_fit(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability over margins, by Newton steps on smoothed targets."""
    n1, n0 = good.sum(), len(good) - good.sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    beta = np.array([2.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> list:
    """(good labels, bad labels, key hash, indicators) of about ``rows`` labelled documents, chosen by a hash of the id.

    Labels are summed by id and texts of one id are one row, so a repeated id does not enlarge the sample.
    """
    label = F.col(label_col).cast("int")
    known = labels.where(F.col(id_col).isNotNull() & label.isin(0, 1)).groupBy(F.col(id_col).alias("key"))
    known = known.agg(F.sum(label).alias("good"), F.sum(1 - label).alias("bad"))
    steps = 1 << 20
    share = min(steps, steps * rows // max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("key", F.lit(7)), F.lit(steps)) < share)
    known = known.withColumn("order", F.xxhash64("key", F.lit(9)))

    def lists(given: Iterator[tuple]) -> Iterator[tuple]:
        for key, good, bad, order, text in given:
            yield key, good, bad, order, indicators(text).tobytes()

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).cast(kind).alias("k"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(known), F.col("k") == F.col("key"))  # about `rows` ids
    found = map_rows(
        texts.select("k", "good", "bad", "order", "text"),
        f"key {kind}, good long, bad long, order long, buckets binary",
        lists,
        256,
    )
    one = found.groupBy("key", "good", "bad", "order").agg(F.min("buckets").alias("buckets"))
    return [tuple(r) for r in one.select("good", "bad", "order", "buckets").orderBy("order", "key").collect()]


def fit_classifier(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
    smooth: float = 1.0,
    cost: float = 1.0,
) -> Classifier:
    """Fit on about ``fit_rows`` labelled documents, chosen by a hash of the id: the bound of the training sample.

    Rows with a null label or id teach nothing; a document with labels of both classes counts with both. With one class
    only every score is that class's share, 1 or 0; without labels it is 0.5.
    """
    rows = [
        (side, order, np.frombuffer(buckets, np.int32).astype(np.int64))
        for good, bad, order, buckets in _sample(docs, labels, id_col, text_col, label_col, fit_rows)
        for side in [True] * bool(good) + [False] * bool(bad)
    ]
    good = np.array([r[0] for r in rows], bool)
    if good.all() or not good.any():
        flat = np.zeros(BUCKETS)
        return Classifier(flat, flat, 0.0, 1.0, 0.0 if not rows else 500.0 if good[0] else -500.0)
    data = [r[2] for r in rows]
    counts = np.zeros((BUCKETS, 2))
    for row, side in zip(data, good):
        counts[row, 0 if side else 1] += 1
    shares = (counts + smooth) / (counts + smooth).sum(axis=0)
    ratios = np.log(shares[:, 0] / shares[:, 1])
    apart = np.array([r[1] % 4 == 0 for r in rows], bool)
    if len(set(good[apart])) < 2 or len(set(good[~apart])) < 2:
        apart = np.zeros(len(rows), bool)
    signs = np.where(good, 1.0, -1.0)
    costs = cost * np.where(good, 1.0, max(1.0, good.sum() / (~good).sum() / 2))
    use = np.flatnonzero(~apart)
    weights, bias = dual_coordinate_descent([data[i] for i in use], signs[use], ratios, costs[use])
    model = Classifier(weights * ratios, ratios, bias, 1.0, 0.0)
    judged = np.flatnonzero(apart) if apart.any() else use
    slope, shift = sigmoid_fit(np.array([model.margin(data[i]) for i in judged]), good[judged])
    return model._replace(slope=slope, shift=shift)


def quality_score(model: Classifier, spark: SparkSession):
    """The score of a text column: one pass where the rows lie. Null texts are scored like empty ones."""
    held = spark.sparkContext.broadcast(model)  # two arrays of BUCKETS numbers

    @F.arrow_udf(DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held.value
        for batch in batches:
            scores = [own.score(indicators(t)) for part in slices([batch]) for t in part.to_pylist()]
            yield pa.array(scores, pa.float64())

    return scored


def score_texts(
    docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``id_col``, ``score`` and ``predicted`` (1 from ``threshold`` on) of every row; other columns are not read."""
    scored = docs.select(F.col(id_col), quality_score(model, docs.sparkSession)(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def learnable(docs: DataFrame, id_col: str = "doc_id", modulus: int = 4, held: int = 2) -> DataFrame:
    """Rows that labels may be learned from."""
    return docs.where(id_remainder(F.col(id_col), modulus) != held)
