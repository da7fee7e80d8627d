"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of a text's letters (lower case, all else one space), hashed
into ``BUCKETS`` places. Document frequencies count all training rows. The weights come from
follow-the-regularised-leader with L1 and L2 penalties on a bounded sample: up to
``per_label`` rows of each label, by a hash of the row, the same at every size. Tasks turn the
sample's texts into sparse features; only these reach the driver. A fifth of
the sample is kept from the fit and sets the temperature of the probabilities.

A null text, a text without letters, and any text if there are no labels: ``und``, score 0.
Rows whose label is null are not learned from. More than ``MOST_LABELS`` labels are an error. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.llm.common import by_weight, keyed, short_batches

BUCKETS = 1 << 13
UNKNOWN = "und"
# Rows of one label that the fit may use, and characters counted at a time.
PER_LABEL = 1200
# Labels that the weights, and the driver, have room for; more fail the run.
MOST_LABELS = 200
CHUNK = 1 << 20
ROUNDS, ALPHA, BETA, L1, L2 = 3, 0.3, 1.0, 0.3, 1.0
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@lru_cache(1)
def letters() -> np.ndarray:
    """True for each code point that is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def counts_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket for each text, and whether it has a letter."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    has = np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters()[points]
        has[i] = is_letter.any()
        if not has[i]:
            continue
        points = np.where(is_letter, points, np.uint32(32))
        # One space for each run of anything but letters, and one at both ends.
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        points = np.concatenate([[np.uint32(32)], points[keep], [np.uint32(32)]]).astype(np.uint32)
        one = points * _FACTORS[0]
        two = one[:-1] * _FACTORS[1] + points[1:]
        three = two[:-1] * _FACTORS[2] + points[2:]
        for grams in (one, two, three):
            mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out[i] += np.bincount((mixed >> np.uint32(19)).astype(np.int64), minlength=BUCKETS)
    return out, has


def _parts(texts: list[str | None]):
    for part in by_weight(range(len(texts)), lambda i: len(texts[i] or "") + 4 * BUCKETS // 8, CHUNK):
        yield part, *counts_of([texts[i] for i in part])


def _frequencies(batches):
    df, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for _, counts, has in _parts(batch.column("text").to_pylist()):
            df += (counts > 0).sum(0)
            rows += int(has.sum())
    at = np.append(np.flatnonzero(df), -1)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.where(at < 0, rows, df[at]), pa.int64())], names=["bucket", "n"])


def features(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _sparse(idf: np.ndarray):
    """Rows (text, lang, draw) with the features that are not zero in place of the text."""

    def run(batches):
        for batch in batches:
            at, values = [], []
            for _, counts, _ in _parts(batch.column("text").to_pylist()):
                for row in features(counts, idf).astype(np.float32):
                    held = np.flatnonzero(row)
                    at.append(held.astype(np.int16).tobytes())
                    values.append(row[held].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("draw"), pa.array(at, pa.binary()), pa.array(values, pa.binary())],
                names=["lang", "draw", "at", "value"],
            )

    return run


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def follow_leader(x: list[tuple], y: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (bucket, class) after ``rounds`` over the rows in order; most are exactly zero.

    A row of ``x`` is the buckets it has and their values.
    """
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(at):
        zi, ni = z[at], n[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(rounds):
        for (at, value), label in zip(x, y):
            w = weights(at)
            p = softmax(value @ w)
            p[label] -= 1.0
            g = value[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section over its logarithm."""

    def loss(t):
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    a, b, ratio = -4.0, 3.0, (5**0.5 - 1) / 2
    while b - a > 1e-3:
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    divisor: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for part, counts, has in _parts(texts):
            if not self.labels:
                continue
            p = softmax(features(counts, self.idf) @ self.weights / self.divisor)
            for i, row, known in zip(part, p, has):
                if known:
                    labels[i], scores[i] = self.labels[int(row.argmax())], float(row.max())
        return labels, scores


def train(rows: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Learn from ``rows`` (doc_id, text_hash, text, lang); all of them give the document frequencies."""
    counted = rows.select("text").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = {r["bucket"]: r["n"] for r in counted.collect()}  # BUCKETS + 1 rows at most
    total = df.pop(-1, 0)
    idf = np.zeros(BUCKETS)
    for bucket, n in df.items():
        idf[bucket] = np.log((1 + total) / (1 + n)) + 1
    by_label = rows.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LABELS + 1)
    labels = {r["lang"]: r["n"] for r in by_label.collect()}
    if len(labels) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels: is this a column of languages?")
    if not labels:
        return Model([], idf, np.zeros((BUCKETS, 0)), 1.0)
    names = sorted(labels)
    # A hash of the row picks the sample; a little more than asked for, then cut to the exact number.
    draw = F.xxhash64("doc_id", "text_hash")
    share = F.pmod(draw, F.lit(1 << 30)) / float(1 << 30)
    wanted = F.create_map(*[F.lit(v) for k in names for v in (k, 1.5 * per_label / labels[k])])
    drawn = rows.where(F.col("lang").isNotNull() & (share < F.element_at(wanted, F.col("lang"))))
    sparse = drawn.select("text", "lang", draw.alias("draw")).mapInArrow(_sparse(idf), "lang string, draw long, at binary, value binary")
    order = sparse.orderBy("draw", "lang").limit(2 * per_label * len(names)).collect()
    taken = dict.fromkeys(names, 0)
    x, y = [], []
    for r in order:
        taken[r["lang"]] += 1
        if taken[r["lang"]] <= per_label:
            x.append((np.frombuffer(r["at"], np.int16).astype(np.int64), np.frombuffer(r["value"], np.float32)))
            y.append(names.index(r["lang"]))
    y, fit = np.array(y), np.arange(len(y)) % 5 != 4
    weights = follow_leader(list(itertools.compress(x, fit)), y[fit], len(names))
    logits = [value @ weights[at] for at, value in itertools.compress(x, ~fit)]
    divisor = temperature(np.array(logits), y[~fit]) if logits else 1.0
    return Model(names, idf, weights, divisor)


def _predict(model: Model):
    def run(batches):
        for batch in batches:
            labels, scores = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "text_hash", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, learn_from: Column, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, text_hash, lang_pred and score for each row; labels are read where ``learn_from`` holds."""
    short_batches(docs.sparkSession)
    model = train(keyed(docs.where(learn_from & F.col("text").isNotNull()), "lang"), per_label)
    return keyed(docs).mapInArrow(_predict(model), "doc_id long, text_hash long, lang_pred string, score double")


def _recognised(model: Model, least: float):
    def run(batches):
        for batch in batches:
            labels, scores = model.predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array([a != UNKNOWN and b >= least for a, b in zip(labels, scores)], pa.bool_()))

    return run


def recognised(docs: DataFrame, learn_from: Column, least: float = 0.4, per_label: int = PER_LABEL) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with at least that score; no shuffle."""
    short_batches(docs.sparkSession)
    model = train(keyed(docs.where(learn_from & F.col("text").isNotNull()), "lang"), per_label)
    return docs.mapInArrow(_recognised(model, least), docs.schema)
