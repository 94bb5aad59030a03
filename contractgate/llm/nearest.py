"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation is three rounds of random signs and a fast Hadamard
transform. A unit vector's axis is the signed coordinate axis nearest to its
rotated image (2 * dim of them); a table's bucket is the pair of axes under two
pseudo-rotations. Queries probe, in each table, the buckets whose axes are
nearest to the query's images; every candidate is then compared exactly, by
Euclidean distance in double precision on the original vectors.

How it is spread: the rows are dealt by hash into index chunks of bounded size
(vectors, and per table the rows sorted by bucket), the queries into blocks of
bounded size with their probes. Each block meets each chunk in an ordinary join
on the chunk's number and yields only the best ``k`` of that chunk, so what
is shuffled afterwards is ``k`` rows per query and chunk. Nothing is collected to
the driver or broadcast. Several rows of one vector lie in different chunks.

Recall is set by ``tables`` and ``probes`` and does not depend on the number of
rows through any cap: every row is indexed, every candidate is compared.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; repeated rows (same id, same vector) count once;
vectors of another length than the query's are not its candidates; fewer
candidates than ``k`` are all returned where found; ties go to the smaller id;
a null id takes no part; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

_TOP_AXES = 32  # axes of each rotation that are combined into probes


def hadamard(x: np.ndarray) -> np.ndarray:
    """Unnormalised fast Walsh-Hadamard transform of the rows (length a power of two)."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(n, d)
        h *= 2
    return x


def rotated(x: np.ndarray, table: int, part: int, seed: int) -> np.ndarray:
    """Rows under one pseudo-rotation, as scores of the signed axes (+, then -)."""
    rng = np.random.default_rng((seed, table, part))
    for _ in range(3):
        x = hadamard(x * rng.choice((-1.0, 1.0), x.shape[1]))
    return np.hstack((x, -x))


def _unit(x: np.ndarray) -> np.ndarray:
    d = 1 << max(0, (x.shape[1] - 1).bit_length())
    x = x / np.abs(x).max(axis=1, keepdims=True)  # before the square, which may overflow
    return np.pad(x / np.linalg.norm(x, axis=1, keepdims=True), ((0, 0), (0, d - x.shape[1])))


def buckets(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    a, b = (rotated(x, table, part, seed) for part in (0, 1))
    return a.argmax(axis=1) * a.shape[1] + b.argmax(axis=1)


def probes_of(x: np.ndarray, table: int, seed: int, probes: int) -> np.ndarray:
    """Buckets of each row in falling order of the summed scores of their two axes."""
    a, b = (rotated(x, table, part, seed) for part in (0, 1))
    top = min(_TOP_AXES, a.shape[1])
    ia, ib = (np.argsort(-s, axis=1, kind="stable")[:, :top] for s in (a, b))
    score = np.take_along_axis(a, ia, 1)[:, :, None] + np.take_along_axis(b, ib, 1)[:, None, :]
    best = np.argsort(-score.reshape(len(x), -1), axis=1, kind="stable")[:, :probes]
    return np.take_along_axis(ia, best // top, 1) * a.shape[1] + np.take_along_axis(ib, best % top, 1)


def _vectors(batch: pa.RecordBatch, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("ids")[k].values.to_numpy(zero_copy_only=False).astype(np.int64)
    flat = batch.column("vectors")[k].values.flatten().to_numpy(zero_copy_only=False)
    return ids, flat.reshape(len(ids), dim)


def _indexer(tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                dim, chunk = batch.column("dim")[k].as_py(), batch.column("chunk")[k].as_py()
                ids, x = _vectors(batch, k, dim)
                codes = np.stack([buckets(_unit(x), t, seed) for t in range(tables)]).astype(np.int32)
                order = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
                codes = np.take_along_axis(codes, order, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([chunk], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in (ids, x, order, codes))],
                    names=["dim", "chunk", "ids", "vectors", "order", "codes"])

    return run


def _prober(tables: int, probes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                dim = batch.column("dim")[k].as_py()
                ids, x = _vectors(batch, k, dim)
                found = np.stack([probes_of(_unit(x), t, seed, probes) for t in range(tables)], axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in (ids, x, found))],
                    names=["dim", "q_ids", "q_vectors", "q_probes"])

    return run


def _searcher(tables: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                cell = lambda name, kind: np.frombuffer(batch.column(name)[r].as_py(), kind)  # noqa: E731, B023
                dim = batch.column("dim")[r].as_py()
                ids, x = cell("ids", np.int64), cell("vectors", np.float64).reshape(-1, dim)
                order, codes = cell("order", np.int32).reshape(tables, -1), cell("codes", np.int32).reshape(tables, -1)
                q_ids, q = cell("q_ids", np.int64), cell("q_vectors", np.float64).reshape(-1, dim)
                wanted = cell("q_probes", np.int32).reshape(len(q_ids), tables, -1)
                out: tuple[list, list, list] = ([], [], [])
                for i, (q_id, v) in enumerate(zip(q_ids, q)):
                    near = np.zeros(len(ids), dtype=bool)
                    for t in range(tables):
                        lo, hi = (np.searchsorted(codes[t], wanted[i, t], side) for side in ("left", "right"))
                        n = hi - lo
                        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                        near[order[t][at]] = True
                    rows = np.flatnonzero(near)
                    rows = rows[(ids[rows] != q_id) | (x[rows] != v).any(axis=1)]  # not the query itself
                    d = np.sqrt(((x[rows] - v) ** 2).sum(axis=1))
                    best = np.lexsort((ids[rows], d))[:k]
                    for column, values in zip(out, (np.full(len(best), q_id), ids[rows][best], d[best])):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, tables: int = 24, probes: int = 240, seed: int = 3,
            chunk_rows: int = 4096, block_rows: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row of ``vectors`` for which ``is_query`` holds."""
    value = F.col("embedding").cast("array<double>")
    whole = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole & F.exists(value, lambda c: c != 0))
    # the id goes through a hash, so that rows of one vector, or of one id, spread over the chunks
    rows = good.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(value, lambda c: c + 0.0).alias("embedding"),
                       F.size("embedding").alias("dim"), is_query.alias("query")).groupBy("vec_id", "embedding", "dim").agg(F.max("query").alias("query"))
    rows = materialise(rows, "vectors")
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("query").cast("int")).alias("nq"))
    sizes = sizes.select("dim", F.ceil(F.col("n") / chunk_rows).alias("chunks"), F.ceil(F.col("nq") / block_rows).alias("blocks"))
    deal = F.xxhash64("vec_id", "embedding")
    packed = lambda df, name, of: df.join(F.broadcast(sizes), "dim").groupBy(  # noqa: E731  one row per length of vector
        "dim", F.pmod(deal, F.col(of)).alias(name)).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("v")).select(
        "dim", name, F.col("v.vec_id").alias("ids"), F.col("v.embedding").alias("vectors"))
    index = packed(rows, "chunk", "chunks").mapInArrow(
        _indexer(tables, seed), "dim int, chunk bigint, ids binary, vectors binary, order binary, codes binary")
    index = materialise(index, "index")
    blocks = packed(rows.where("query"), "block", "blocks").mapInArrow(
        _prober(tables, probes, seed), "dim int, q_ids binary, q_vectors binary, q_probes binary")
    blocks = blocks.join(F.broadcast(sizes), "dim").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))).drop("chunks", "blocks")
    found = index.join(blocks, ["dim", "chunk"]).mapInArrow(_searcher(tables, k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
