"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words, word pairs
and character 3- to 5-grams; a softmax layer gives the class. Vectors and layer
are trained together by numpy stochastic gradient descent.

Training uses a bounded sample of labelled rows (``sample_per_class``, the
rows with the smallest hash of their id) and every feature of the whole text of
each sampled document: tasks count its buckets, so what training holds of a
document is at most two numbers for each of the ``2 ** bits`` buckets.
The sample's size does not depend on the size of the table. Scoring reads
every feature of every text: as the layer is linear, a feature's vector and the
layer fold into one weight per bucket, and a score is the average weight.

Defined cases: a null or empty text has no features and gets the score of the
layer's bias; very long texts are read in slices; labels that are null are
ignored, a doc_id labelled more than once counts with its smallest label;
without rows of both classes every score is 0.5; repeated rows get a score
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SLICE = 1 << 18  # characters hashed at once


def _powers(base: np.uint64) -> np.ndarray:
    p = np.full(_SLICE + 16, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p)


_UP, _DOWN = _powers(_BASE), _powers(_BASE_INVERSE)


def _buckets(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * _MIX
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _slice_features(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Buckets of the words, word pairs and character n-grams of one slice."""
    n = len(codes)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((codes + np.uint64(1)) * _UP[:n], out=sums[1:])
    out = []
    for size in (3, 4, 5):
        if n >= size:
            out.append(_buckets((sums[size:] - sums[:-size]) * _DOWN[: n - size + 1], size, bits))
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if len(starts):
        words = (sums[ends] - sums[starts]) * _DOWN[starts]
        out.append(_buckets(words, 101, bits))
        # a pair is its two words in order; a word after itself is one feature of its own
        pairs = np.where(words[1:] == words[:-1], np.uint64(0), words[:-1] * np.uint64(31) + words[1:])
        out.append(_buckets(pairs, 103, bits))
    return out


def features(text: str, bits: int) -> Iterator[np.ndarray]:
    """Arrays of buckets that together are the features of the whole text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    for at in range(0, len(codes), _SLICE):
        # four characters more, so that no n-gram is lost at a cut
        yield from _slice_features(codes[at: at + _SLICE + 4].astype(np.uint64), bits)


@dataclass
class Model:
    weights: np.ndarray  # of each bucket, for the second class against the first
    bias: float
    bits: int

    def score(self, text: str) -> float:
        total, n = 0.0, 0
        for ids in features(text, self.bits):
            total += float(self.weights[ids].sum(dtype=np.float64))
            n += len(ids)
        return 1 / (1 + np.exp(-np.clip(total / max(n, 1) + self.bias, -60, 60)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int, dim: int = 8, epochs: int = 6, rate: float = 0.6,
          seed: int = 7) -> Model | None:
    """Stochastic gradient descent over (buckets of a document, times each occurs, its class)."""
    if len({y for _, _, y in rows}) < 2:
        return None
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, ((1 << bits), dim)).astype(np.float32)
    layer, bias = np.zeros((2, dim), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, times, y = rows[i]
            share = (times / max(times.sum(), 1)).astype(np.float32)
            own = vectors[ids]
            mean = share @ own
            out = layer @ mean + bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[y] -= 1  # gradient of the loss by the layer's output
            step = rate * (1 - done / steps)
            # features are averages of thousands; vectors take a step scaled by the share of the feature
            vectors[ids] = own - step * np.outer(share * min(len(ids), 256), p @ layer)
            layer -= step * np.outer(p, mean)
            bias -= 0.1 * step * p
            done += 1
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]), bits)


def sample_labels(labels: DataFrame, label: str, keep: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` doc_ids of each class, by the smallest hash of the id."""
    known = (labels.where(keep & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min(F.col(label).cast("int")).alias("y")))
    order = F.xxhash64(F.lit(11), F.col("doc_id")), F.col("doc_id")
    parts = [known.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def _counted(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a whole text in rising order, and the times each occurs."""
    ids, times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for part in features(text, bits):
        more, n = np.unique(part, return_counts=True)
        ids, at = np.unique(np.concatenate((ids, more)), return_inverse=True)
        times = np.bincount(at, np.concatenate((times, n)), len(ids)).astype(np.int64)
    return ids, times


def _counter(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [_counted(text.as_py(), bits) for text in batch.column(2)]
            ids, times = ([c[k].astype(np.int32) for c in counted] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))],
                names=["doc_id", "y", "ids", "times"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str, keep: Column, bits: int = 18, sample_per_class: int = 1500) -> Model | None:
    chosen = sample_labels(labels, label, keep, sample_per_class)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).join(
        F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")  # at most 2 * sample_per_class ids
    found = rows.mapInArrow(_counter(bits), "doc_id bigint, y int, ids array<int>, times array<int>").toArrow()
    first = {}
    for doc_id, y, ids, times in zip(found["doc_id"].to_pylist(), found["y"].to_pylist(), found["ids"], found["times"]):
        first.setdefault(doc_id, (np.asarray(ids.values), np.asarray(times.values), y))  # repeated rows train once
    return train([first[k] for k in sorted(first)], bits)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every row of ``docs`` with its ``score``; all its columns are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits float32: 1 MB

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([0.5 if m is None else m.score(x) for x in texts], dtype="float64")

    return docs.withColumn("score", scored(text_of()))
