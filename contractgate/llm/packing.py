"""Best-fit packing, by best-two-fit.

A document becomes the ids of its text plus one end id. Documents longer than
a sequence are cut into full pieces (the first one takes the remainder); every
other document stays whole. Pieces are packed into sequences of at most
``capacity`` ids: a sequence is filled greedily, largest fitting piece first;
what gap is left is then closed by replacing the smallest piece of the
sequence with two unpacked pieces that fit the widened gap more tightly.

How it is spread: only the number of pieces of each length matters for the
plan, so Spark counts lengths (at most ``capacity`` of them), the driver packs
that histogram (its size does not depend on the number of documents), and the
resulting plan is a small table of slots, handed out to the pieces by their
rank within their length. Ranks come from per-partition counters and an offset
per (length, partition), so no length is ever gathered in one task.

Defined cases: a null or empty text is one piece holding the end id only; a
repeated row is packed as often as it occurs; a null doc_id stays null; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, text_of

# A space inside a longer run of white space: the tokenizer keeps such runs
# together, so these texts are encoded as a whole.
_INNER_SPACE = re.compile(r" (?!\S)(?<=\s )")
_SPECIAL = "<|endoftext|>"
# Distinct words remembered by one Python worker; later ones are encoded each time.
_REMEMBERED_WORDS = 500_000
_ENCODERS: dict[tuple, WordEncoder] = {}


class WordEncoder(dict):
    """Space-led word -> its ids as little-endian uint32 bytes.

    The vocabulary's pre-tokenizer always starts a new pre-token at a space
    that follows anything but white space, and at the last space of a run, so a
    text's ids are those of its first word and of its space-led words in turn.
    ``ranks`` names the same vocabulary as a rank table; it only makes the
    words met for the first time faster, the ids are the same.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(vocabulary)
        self.ranked = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranked = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def whole(self, text: str) -> bytes:
        if self.ranked is None or _SPECIAL in text:
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranked.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.whole(" " + word)
        if len(self) < _REMEMBERED_WORDS:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if _INNER_SPACE.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        return (self.whole(first) if first else b"") + b"".join(map(self.__getitem__, rest))


def _encoder(*key: str | None) -> WordEncoder:
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(*key)
    return _ENCODERS[key]


PIECE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()),
])


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    at = n % capacity or min(n, capacity)
    yield 0, at
    while at < n:
        yield at, capacity
        at += capacity


def _cutter(key: tuple, capacity: int, end_id: int, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, seen = _encoder(*key), TaskContext.get().partitionId(), Counter()
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.ids(text.as_py()) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start: 4 * (start + length)]
                    rows.append((doc_id, k, start, length, zlib.crc32(own),
                                 np.frombuffer(own, "<u4") if keep_ids else None, part, seen[length]))
                    seen[length] += 1
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=PIECE_SCHEMA.names)

    return run


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, ranks: str | None = None,
           pattern: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece, with its place among the pieces of its length in its partition."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_cutter((vocabulary, ranks, pattern), capacity, end_id, keep_ids), PIECE_SCHEMA)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best-two-fit over the histogram of lengths: [(lengths of a sequence, how many such sequences)].

    Sequences filled alike are made together, as many as the scarcest of their
    lengths allows, so the list is about as long as there are lengths.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    made = []
    sizes = np.arange(capacity + 1)
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        free = left.copy()
        free[longest] -= 1
        inside, gap = [longest], capacity - longest

        def largest() -> np.ndarray:
            return np.maximum.accumulate(np.where(free > 0, sizes, 0))  # largest free length up to each size

        while gap and (take := int(largest()[gap])):
            inside.append(take)
            free[take] -= 1
            gap -= take
        while gap and len(inside) > 1:
            small = min(inside)
            room = gap + small
            first = np.flatnonzero(free[:room]) if room else np.array([], dtype=int)
            if not len(first):
                break
            fit = largest()
            second = fit[room - first]
            # the same length twice needs two of it; else the next smaller one
            twice = (second == first) & (free[first] < 2)
            second = np.where(twice, fit[np.maximum(np.minimum(room - first, first - 1), 0)], second)
            total = np.where(second > 0, first + second, 0)
            best = int(total.argmax())
            if total[best] <= small:
                break
            inside.remove(small)
            free[small] += 1
            for take in (int(first[best]), int(second[best])):
                inside.append(take)
                free[take] -= 1
            gap = capacity - sum(inside)
        need = Counter(inside)
        times = min(int(left[x]) // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= times * n
        made.append((sorted(inside, reverse=True), times))
    return made


def _slots(made: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length, first rank) of runs of slots, with the first rank, first sequence and offset of each."""
    used, out, sequence = Counter(), [], 0
    for inside, times in made:
        offset = 0
        for length in inside:
            out.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    out.sort()
    a = np.array(out, dtype=np.int64).reshape(-1, 4)
    return (a[:, 0] << 40) | a[:, 1], a[:, 1], a[:, 2], a[:, 3]


def pack(found: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to (materialised) pieces."""
    per_part = found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    keys, ranks, sequences, offsets = _slots(plan(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        run = np.searchsorted(keys, (length.to_numpy() << 40) | rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": sequences[run] + rank.to_numpy() - ranks[run], "offset": offsets[run]})

    placed = found.join(starts, ["part", "length"]).withColumn("place", place("length", F.col("first") + F.col("nth")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset", "ids")


def best_fit_pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, ranks: str | None = None,
                  pattern: str | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids (null unless ``keep_ids``)."""
    found = materialise(pieces(docs, vocabulary, capacity, end_id, ranks, pattern, keep_ids), "pieces")
    return pack(found, capacity)
