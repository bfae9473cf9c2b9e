"""Quality by naive Bayes support vectors.

A text's features are hashed n-gram indicators: its words and pairs of words, and
runs of one to three word shapes (a shape keeps punctuation, turns runs of letters
and digits into one mark each, and says whether the word repeats the one before).
Indicators are scaled by the log-count ratio of the two classes, texts to unit
length. A linear hinge-loss model is fitted by dual coordinate descent. Margins of
texts held out in folds give a logistic curve that turns margins into scores.

The model is fitted on at most ``max_rows`` labelled texts (the least by a hash of
the id); a text has BUCKETS features at most, however long it is, so the fit is bounded.
The scores cover every text. Labels are joined by id; an id with labels that differ is
not learned; of document rows that repeat a labelled id, each is a text of its own until
``max_rows``. Without labels of both classes every text gets the share of label 1 (0.5
without any). Null and empty texts have no features and score by the bias alone. Equal
texts have equal scores. Very long texts are taken whole, one at a time. An empty table
gives no rows. Columns besides those named are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm import _ragged as R
from gridloom.llm._spark import map_texts

BUCKETS = 1 << 18
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48
_CLASS[128:] = 128


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each word's shape; a word equal to the one before in its text has another hash."""
    if not len(starts):
        return np.empty(0, np.uint64)
    kind = _CLASS[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[starts] = True
    new &= ~R._IS_WHITE[data]
    place = np.concatenate(([0], np.cumsum(new)))
    out = R.span_hashes(kind[new], place[starts], place[ends])
    same = np.concatenate(([False], words[1:] == words[:-1]))
    same[at[:-1][at[:-1] < len(words)]] = False
    return np.where(same, R.mix(out), out)


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets of each text, offsets by text)."""
    starts, ends, by = R.word_spans(data, at)
    words = R.span_hashes(data, starts, ends)
    shape = shapes(data, starts, ends, words, by)
    parts = []
    for salt, (items, k) in enumerate(((words, 1), (words, 2), (shape, 1), (shape, 2), (shape, 3))):
        hashed, of = R.shingle_hashes(items, by, k)
        bucket = (R.mix(hashed + np.uint64(salt)) >> np.uint64(46)).astype(np.int64)
        parts.append(R.owners(of) * BUCKETS + bucket)
    key = np.sort(np.concatenate(parts))
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    return (key % BUCKETS).astype(np.int32), np.searchsorted(key, np.arange(len(at)) * BUCKETS)


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Weights (the last is the bias) of the hinge-loss model over unit-length scaled indicators, by dual coordinate descent."""
    w = np.zeros(len(ratio) + 1)
    values = []
    for f in rows:
        v = np.append(ratio[f], 0.0)
        v[:-1] /= max(np.sqrt((v**2).sum()), 1e-9)
        v[-1] = 0.5
        values.append((np.append(f, len(ratio)), v, float((v**2).sum())))
    weight = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1))) * cost
    alpha = np.zeros(len(y))
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in random.permutation(len(y)):
            f, v, norm = values[i]
            slope = y[i] * (w[f] @ v) - 1
            now = min(max(alpha[i] - slope / norm, 0.0), weight[i])
            if now != alpha[i]:
                w[f] += (now - alpha[i]) * y[i] * v
                most = max(most, abs(now - alpha[i]))
                alpha[i] = now
        if most < 1e-3:
            break
    return w


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of the smoothed shares of each indicator in the two classes."""
    counts = [np.bincount(np.concatenate([r for r, s in zip(rows, y, strict=True) if s == c] or [np.empty(0, np.int32)]), minlength=BUCKETS) + 1.0 for c in (1, -1)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


@dataclass
class Model:
    ratio: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def margins(self, bucket: np.ndarray, at: np.ndarray) -> np.ndarray:
        size = np.diff(at)
        full = np.flatnonzero(size)
        out = np.full(len(size), 0.5 * self.weights[-1])
        if len(full):
            r = self.ratio[bucket]
            dots = np.add.reduceat(r * self.weights[bucket], at[:-1][full])
            out[full] += dots / np.maximum(np.sqrt(np.add.reduceat(r * r, at[:-1][full])), 1e-9)
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        data, offsets = R.text_bytes(column)
        out = np.empty(len(offsets) - 1)
        for lo, hi, d, at in R.slabs(data, offsets, 1 << 20):
            out[lo:hi] = self.margins(*features(d, at))
        return 1 / (1 + np.exp(-np.clip(self.slope * out + self.offset, -500, 500)))


def logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the curve for label 1 (J. Platt's targets), by Newton steps."""
    ones, zeros = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        g = np.array([((p - target) * margins).sum(), (p - target).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margins**2).sum() + 1e-6, (s * margins).sum()], [(s * margins).sum(), s.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def fit_rows(rows: list[np.ndarray], labels: list[int], folds: int = 3) -> Model:
    y = np.where(np.array(labels, int) == 1, 1, -1)
    if len(set(y.tolist())) < 2:
        share = 0.5 if not len(y) else float((y > 0).mean() * (len(y) + 1) + 0.5) / (len(y) + 2)
        return Model(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS + 1, np.float32), 0.0, float(np.log(share / (1 - share))))
    fold = np.random.default_rng(5).integers(0, folds, len(y))
    margins = np.zeros(len(y))

    def fitted(own: np.ndarray) -> Model:
        some = [rows[i] for i in own]
        ratio = log_count_ratio(some, y[own])
        return Model(ratio, descend(some, y[own], ratio), 1.0, 0.0)

    for k in range(folds):
        own, other = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(set(y[own].tolist())) < 2 or not len(other):
            continue
        held = fitted(own)
        size = np.array([len(rows[i]) for i in other])
        margins[other] = held.margins(np.concatenate([rows[i] for i in other]), np.concatenate(([0], np.cumsum(size))))
    whole = fitted(np.arange(len(y)))
    return Model(whole.ratio.astype(np.float32), whole.weights.astype(np.float32), *logistic(margins, y))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learn: Column | None = None, max_rows: int = 4000) -> Model:
    """A model from labelled texts; ``learn`` is a condition on the label rows' id. The labels' table is not broadcast: its bounded sample is."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_rows).select("id", "label").collect()  # max_rows at most
    if not sample:
        return fit_rows([], [])
    chosen = F.broadcast(docs.sparkSession.createDataFrame(sample, known.select("id", "label").schema))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id").select("id", "label", "text")

    def kernel(batch: pa.RecordBatch) -> list:
        data, offsets = R.text_bytes(batch.column(2))
        made: list[bytes] = []
        for _, _, d, at in R.slabs(data, offsets, 1 << 20):
            bucket, by = features(d, at)
            made += [bucket[a:b].tobytes() for a, b in zip(by[:-1].tolist(), by[1:].tolist(), strict=True)]
        return [pa.array(made, pa.binary())]

    rows, y = [], []
    found = map_texts(texts, ["id", "label", "text"], "features binary", kernel)
    for r in found.orderBy(F.xxhash64("id"), "id", "features").toLocalIterator(prefetchPartitions=False):
        row = np.frombuffer(bytes(r["features"]), np.int32)
        if len(rows) >= max_rows:
            break
        rows.append(row)
        y.append(r["label"])
    return fit_rows(rows, y)


def score(docs: DataFrame, model: Model, columns: list, *, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The columns, then score and predicted of every row."""

    def kernel(batch: pa.RecordBatch) -> list:
        scores = model.score(batch.column(batch.num_columns - 1))
        return [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]

    return map_texts(docs, [*columns, F.col(text_col)], "score double, predicted int", kernel)
