"""Ranked lexical search: the best documents for each item of a query set.

Every document is scored by the weights of the item's terms it holds (the
formula is in ``Weights``; all in whole numbers but for the logarithm), and the
``k`` best of each item are found without scoring the others:

Documents are indexed in shards, as posting lists (per term: its documents in
doc_id order, with their impacts) with a sparse table per list that answers
"which posting of this range has the largest impact" in two looks. An interval
of a shard's documents cannot hold a document that scores more than the sum,
over the item's terms, of the largest impact in the interval. The interval of
the highest bound is taken first: the document of its largest single impact is
scored exactly and splits it in two, each with a bound of its own from the
tables; short intervals are scored whole. When no bound reaches the k-th best
score found so far, the shard is done. Intervals are taken many at a time, which
changes the order of the work, not its result.

How it is spread: one pass counts the terms of every whole text and keeps those
that some item asks for (document, terms, frequencies), written once, with the
statistics as ordinary aggregates. A task reads some of these rows, holds one
shard of at most ``SHARD_POSTINGS`` postings (a single document may have more) at a time, and gives at most
``k`` rows for each item; a window ranks these. Items are taken in blocks of a
measured size, so that what is broadcast does not grow with the query set.

Defined cases: a null or empty text has no terms and is not counted; so has an
item, which then has no rows; equal rows of one item count once, differing texts
of one item_id are one item with the terms of all; a null item_id is an item;
documents of one doc_id (repeated rows) are documents each, and may all be
listed; a null doc_id comes after all others among equal scores; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, text_of

# Separators become spaces, A-Z small letters, all other bytes stay.
_LETTERS = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c in _LETTERS else 32 for c in range(256))
# Text of the items broadcast at a time (the items of one block, and their terms).
BLOCK_BYTES = 8 << 20
SHARD_POSTINGS = 1 << 20
# Intervals taken at a time, and postings up to which an interval is scored whole.
WAVE = 256
LEAF = 2048
_LAST = np.int64((1 << 63) - 1)  # orders a null doc_id after all others


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


@dataclass
class Items:
    """One block of items, over the numbers of its terms."""

    ids: list
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocabulary: dict[bytes, int]


@dataclass
class Weights:
    """Of a document with ``n`` terms of which ``tf`` are the term:
    weight(term) * (10^9 tf div (1000 tf + 8 m)), m = 25 + (75 n N div L)."""

    documents: int  # N: documents with a term
    total: int  # L: all their terms
    weight: np.ndarray  # per term of the block: floor(1000 ln((2N + 2) / (2 df + 1)))

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 25 + (75 * n * self.documents) // max(self.total, 1)
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def blocks(items: DataFrame) -> Iterator[Items]:
    """The items (item_id, text), a block of about ``BLOCK_BYTES`` of text at a time."""
    items = materialise(items.select("item_id", text_of().alias("text")).distinct(), "items")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first().n
    n = -(-size // BLOCK_BYTES)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()
        counted: dict = {}
        for r in rows:
            counted.setdefault(r.item_id, Counter()).update(terms(r.text))
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted.values())))}
        ids = [i for i, c in counted.items() if c]
        own = [np.array(sorted((vocabulary[t], c) for t, c in counted[i].items()), dtype=np.int64) for i in ids]
        if ids:
            yield Items(ids, [a[:, 0] for a in own], [a[:, 1] for a in own], vocabulary)


def _counter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.vocabulary
        for batch in batches:
            sizes, ends, term, tf = [], [0], [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                found = Counter(words)
                asked = sorted((known[w], c) for w, c in found.items() if w in known)
                sizes.append(len(words))
                ends.append(ends[-1] + len(asked))
                term.extend(t for t, _ in asked)
                tf.extend(c for _, c in asked)
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(at, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tf, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])

    return run


class Shard:
    """Posting lists of some documents, with a sparse table of positions of the largest impact."""

    def __init__(self, doc_ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: Weights):
        order = np.argsort(doc_ids, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.doc_ids = doc_ids[order]
        row = np.repeat(np.arange(len(doc_ids)), sizes)
        impact = weights.impacts(term, tf, n[row])
        key = term * len(order) + place[row]
        by_list = np.argsort(key)
        self.keys, self.impact = key[by_list], impact[by_list]  # a list's postings stand together, by document
        self.docs = place[row][by_list]
        longest = int(np.bincount(term).max()) if len(term) else 0
        best = np.arange(len(key), dtype=np.int32)
        tables, width = [best], 1
        while 2 * width <= longest:
            a, b = best[:-width], best[width:]
            best = np.where(self.impact[a] >= self.impact[b], a, b)
            tables.append(np.concatenate((best, np.zeros(len(key) - len(best), dtype=np.int32))))
            best, width = tables[-1], 2 * width
        self.tables = np.stack(tables)

    def lists(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first posting, one after the last) of each term."""
        d = len(self.doc_ids)
        return np.searchsorted(self.keys, term * d), np.searchsorted(self.keys, (term + 1) * d)

    def largest(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, value) of the largest impact of each range; value 0 for an empty one."""
        size = hi - lo
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        last = len(self.keys) - 1
        a = self.tables[level, np.minimum(lo, last)]
        b = self.tables[level, np.clip(hi - (1 << level), 0, last)]
        at = np.where(self.impact[a] >= self.impact[b], a, b)
        return at, np.where(size > 0, self.impact[at], 0)


class Best:
    """The k best (score, doc_id) so far: highest score, then smallest doc_id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= max(self.bar[0], 1)
        if good.any():
            scores, ids = np.concatenate((self.scores, scores[good])), np.concatenate((self.ids, ids[good]))
            first = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[first], ids[first]

    @property
    def bar(self) -> tuple[int, int]:
        """(score, doc_id) of the k-th; a document that is not better does not get in."""
        return (int(self.scores[-1]), int(self.ids[-1])) if len(self.scores) == self.k else (0, int(_LAST))


def search(shard: Shard, term: np.ndarray, repeats: np.ndarray, best: Best) -> None:
    """Add the shard's best documents for one item to ``best``."""
    lo, hi = shard.lists(term)
    held = hi > lo
    term, repeats, lo, hi = term[held], repeats[held], lo[held][None], hi[held][None]
    if not len(term):
        return
    base = term * len(shard.doc_ids)
    at, value = shard.largest(lo, hi)
    value = value * repeats
    # pending intervals: ranges of every list, first document, positions and values of the maxima, bound
    pending = [lo, hi, np.zeros(1, dtype=np.int64), at, value, value.sum(axis=1)]
    while True:
        score, doc_id = best.bar
        bound = pending[5]
        alive = (bound > score) | ((bound == score) & (bound > 0) & (shard.doc_ids[pending[2]] < doc_id))
        if not alive.any():
            return
        if not alive.all():
            pending = [x[alive] for x in pending]
        if len(pending[5]) > WAVE:
            order = np.argpartition(-pending[5], WAVE)
            taken, pending = [x[order[:WAVE]] for x in pending], [x[order[WAVE:]] for x in pending]
        else:
            taken, pending = pending, [x[:0] for x in pending]
        lo, hi, first, at, value, _ = taken
        short = (hi - lo).sum(axis=1) <= LEAF
        if short.any():
            _score_whole(shard, lo[short], hi[short], repeats, best)
            lo, hi, first, at, value = (x[~short] for x in (lo, hi, first, at, value))
        if not len(lo):
            continue
        # the document of the largest single impact splits the interval
        rows = np.arange(len(lo))
        split = shard.docs[at[rows, value.argmax(axis=1)]]
        key = base + split[:, None]
        cut = np.searchsorted(shard.keys, key)
        here = shard.keys[np.minimum(cut, len(shard.keys) - 1)] == key
        best.add((np.where(here, shard.impact[np.minimum(cut, len(shard.keys) - 1)], 0) * repeats).sum(axis=1), shard.doc_ids[split])
        # left part: up to the split; right part: after it
        lo, hi = np.concatenate((lo, cut + here)), np.concatenate((cut, hi))
        first = np.concatenate((first, np.minimum(split + 1, len(shard.doc_ids) - 1)))
        at, value = shard.largest(lo, hi)
        value = value * repeats
        pending = [np.concatenate(x) for x in zip(pending, (lo, hi, first, at, value, value.sum(axis=1)))]


def _score_whole(shard: Shard, lo: np.ndarray, hi: np.ndarray, repeats: np.ndarray, best: Best) -> None:
    """Score all documents of the intervals (which share none)."""
    size = (hi - lo).ravel()
    start = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(lo.ravel() - start, size)
    weight = np.repeat(np.broadcast_to(repeats, lo.shape).ravel(), size)
    docs, where = np.unique(shard.docs[at], return_inverse=True)
    scores = np.zeros(len(docs), dtype=np.int64)
    np.add.at(scores, where, shard.impact[at] * weight)
    best.add(scores, shard.doc_ids[docs])


def _searcher(shared, weights, k: int, item_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value, weights.value
        best = [Best(k) for _ in items.ids]
        for shard in shards(batches, weight):
            for term, repeats, own in zip(items.terms, items.repeats, best):
                search(shard, term, repeats, own)
        ids = [i for i, own in zip(items.ids, best) for _ in own.ids]
        doc_id = np.concatenate([own.ids for own in best])
        score = np.concatenate([own.scores for own in best])
        yield pa.RecordBatch.from_arrays([pa.array(ids, item_type), pa.array(doc_id, mask=doc_id == _LAST), pa.array(score)],
                                         names=["item_id", "doc_id", "score"])

    return run


def shards(batches: Iterator[pa.RecordBatch], weights: Weights) -> Iterator[Shard]:
    held, postings = [], 0
    for batch in batches:
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            # as many rows as the shard has room for, at least one
            room = SHARD_POSTINGS - postings + (int(ends[at - 1]) if at else 0)
            stop = int(np.searchsorted(ends, room, side="right"))
            if stop <= at and held:
                yield _shard(held, weights)
                held, postings = [], 0
                continue
            stop = max(stop, at + 1)
            held.append(batch.slice(at, stop - at))
            postings += int(ends[stop - 1] - (ends[at - 1] if at else 0))
            at = stop
    if held:
        yield _shard(held, weights)


def _shard(held: list[pa.RecordBatch], weights: Weights) -> Shard:
    t = pa.Table.from_batches(held)
    ids = t["doc_id"].combine_chunks()
    ids = ids.fill_null(int(_LAST)).to_numpy(zero_copy_only=False)
    flat = [t[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs")]
    sizes = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in held])
    term, tf = flat
    useful = weights.weight[term] > 0
    row = np.repeat(np.arange(len(sizes)), sizes)[useful]
    return Shard(ids, t["n"].to_numpy(), np.bincount(row, minlength=len(sizes)), term[useful], tf[useful], weights)


def _weights(counted: DataFrame, size: int) -> Weights:
    n, total = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, dtype=np.int64)  # of the block's terms: bounded as the block is
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
        df[r.t] = r.df
    return Weights(n, total, np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64))


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    item = items.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {item}, doc_id bigint, score bigint")
    item_type = pa.int64() if item == "bigint" else pa.int32() if item == "int" else pa.string()
    for block in blocks(items):
        shared = spark.sparkContext.broadcast(block)
        counted = materialise(rows.mapInArrow(_counter(shared), "doc_id bigint, n bigint, terms array<int>, tfs array<int>"), "asked-terms")
        weights = spark.sparkContext.broadcast(_weights(counted, len(block.vocabulary)))
        held = counted.where(F.size("terms") > 0).select("doc_id", "n", "terms", "tfs")
        found = found.unionByName(held.mapInArrow(_searcher(shared, weights, k, item_type), found.schema))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
    WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
         c AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
         s AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total FROM c),
         p AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
         w AS (SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
               FROM p CROSS JOIN s GROUP BY term, documents),
         q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
         r AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
         t AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // total)))) AS BIGINT) AS score
               FROM r JOIN w USING (term) JOIN p USING (term) JOIN c USING (doc_id) CROSS JOIN s GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
    FROM t WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
