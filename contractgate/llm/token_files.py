"""Token ids as flat binary files with 64-bit document offsets.

A folder holds, for each part, three flat little-endian files:

* ``<part>.ids``: the ids of its documents one after another, unsigned 16-bit if
  the vocabulary allows it, else 32-bit;
* ``<part>.offsets``: unsigned 64-bit, where each document begins in the part,
  and one more for the part's end;
* ``<part>.docs``: signed 64-bit document ids;

and a Parquet table ``index`` with one row per part. Documents stand in
ascending doc_id order over all parts. A document's place among all ids is its
part's base, a prefix sum of the parts' numbers of ids, plus its offset: no part
is written twice, and no task needs another's numbers.

How it is spread: documents are range-partitioned by doc_id; a task encodes its
range and writes its files under a name of its own, and the index, committed by
Spark, lists the files of the attempts that counted, so a lost executor or a
second attempt leaves no trace in the result (its files are removed at the end).
Reading maps the files into memory and touches only the documents asked for.

Defined cases: a null or empty text has the end id alone; a null doc_id comes
before all others (the index counts them) and is read back as null; documents
of one doc_id (repeated rows) each have their place, ordered by a hash of
their text; an empty table has an index without rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.files import hadoop_fs
from .common import text_of
from .word_ids import WordIds

INDEX = "index"
INDEX_SCHEMA = "part int, name string, width int, n_docs bigint, n_ids bigint, null_docs bigint"
KINDS = ("ids", "offsets", "docs")
# Characters of text encoded at once, and documents read back by one task.
CHARS_AT_ONCE = 1 << 20
DOCS_PER_TASK = 1 << 20
_ENCODERS: dict[str, WordIds] = {}


def _encoder(vocabulary: str) -> WordIds:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordIds(vocabulary)
    return _ENCODERS[vocabulary]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the file system that Spark takes it to be on."""
    p, fs = hadoop_fs(spark, path)
    return str(fs.makeQualified(p).toString())


def file_system(uri: str):
    """(pyarrow file system, path on it) of a qualified path, for use in a task."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def mapped(uri: str, dtype: str) -> np.ndarray:
    """A flat file as an array: mapped into memory where the file system is a local or mounted one."""
    store, path = file_system(uri)
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        size = store.get_file_info(path).size
        return np.memmap(path, dtype=dtype, mode="r") if size else np.zeros(0, dtype=dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def _in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, chars = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc_id.as_py())
            texts.append(text.as_py())
            chars += len(texts[-1])
            if chars >= CHARS_AT_ONCE:
                yield ids, texts
                ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def _writer(folder: str, vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), _encoder(vocabulary)
        name, width = f"{part:08d}-{uuid.uuid4().hex[:12]}", encoder.dtype.itemsize
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        docs = total = nulls = 0
        store, path = file_system(folder)
        out = None
        for ids, texts in _in_chunks(batches):
            if out is None:  # parts without documents have no files
                out = [store.open_output_stream(f"{path}/{name}.{kind}") for kind in KINDS]
                out[1].write(np.zeros(1, dtype="<u8").tobytes())
            encoded = [x + end for x in encoder.encode(texts)]
            ends = total + np.cumsum([len(x) // width for x in encoded], dtype=np.uint64)
            out[0].write(b"".join(encoded))
            out[1].write(ends.astype("<u8").tobytes())
            out[2].write(np.array([0 if i is None else i for i in ids], dtype="<i8").tobytes())
            docs, total, nulls = docs + len(ids), int(ends[-1]), nulls + ids.count(None)
        if out is not None:
            for stream in out:
                stream.close()
            row = [part], [name], [width], [docs], [total], [nulls]
            kinds = pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)],
                                             names=["part", "name", "width", "n_docs", "n_ids", "null_docs"])

    return run


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2, parts: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into ``folder``, which must not exist; returns the index.

    ``parts``: number of ranges; by default that of the input's partitions or of
    shuffle partitions, whichever is more, so that a part grows with neither.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    path, fs = hadoop_fs(spark, folder)
    if not fs.mkdirs(path):
        raise OSError(f"cannot make {folder}")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    parts = parts or max(rows.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.select("doc_id", "text").mapInArrow(_writer(folder, vocabulary, end_id), INDEX_SCHEMA).write.parquet(f"{folder}/{INDEX}")
    index = read_index(spark, folder)
    # files of attempts that did not count
    kept = {r.name for r in index.select("name").toLocalIterator()}
    for status in fs.listStatus(path):
        name = str(status.getPath().getName())
        if status.isFile() and name.rsplit(".", 1)[-1] in KINDS and name.rsplit(".", 1)[0] not in kept:
            fs.delete(status.getPath(), False)
    return index


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part, with the numbers of documents and ids before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one narrow row per part
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/{INDEX}")
    return index.withColumns({f"{n}_before": F.coalesce(F.sum(n).over(before), F.lit(0)) for n in ("n_docs", "n_ids", "null_docs")})


def _reader(folder: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = f"{folder}/{r['name']}"
                lo, hi = r["lo"], r["hi"]
                bounds = mapped(f"{at}.offsets", "<u8")[lo: hi + 1].astype(np.int64)
                ids = mapped(f"{at}.ids", f"<u{r['width']}")
                doc_id = mapped(f"{at}.docs", "<i8")[lo:hi]
                own = [ids[a:b].astype("<u4") for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(doc_id), mask=np.arange(lo, hi) < r["null_docs"]),
                    pa.array(r["n_ids_before"] + bounds[:-1]), pa.array(np.diff(bounds)),
                    pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                    pa.array(own if keep_ids else [None] * len(own), pa.list_(pa.uint32())).cast(pa.list_(pa.int64())),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return run


def read_token_files(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids (null unless ``keep_ids``) of every document, from the files."""
    folder = qualified(spark, folder)
    index = read_index(spark, folder)
    step = F.lit(DOCS_PER_TASK if not keep_ids else 1 << 12).cast("bigint")
    pieces = index.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_docs") - 1, step))).withColumn(
        "hi", F.least(F.col("lo") + step, F.col("n_docs")))
    # a row is work for a task: dealt evenly over as many tasks as there are files
    tasks = max(1, index.count())
    return pieces.repartition(tasks).mapInArrow(
        _reader(folder, keep_ids), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids array<bigint>")


class TokenFiles:
    """Random access to one folder from one process: ``files[k]`` gives the ids of the k-th document of all."""

    def __init__(self, spark: SparkSession, folder: str):
        folder = qualified(spark, folder)
        rows = read_index(spark, folder).orderBy("part").collect()  # one narrow row per part
        self.parts = [(r.name, r.width) for r in rows]
        self.first = np.array([r.n_docs_before for r in rows], dtype=np.int64)
        self.n_docs = int(rows[-1].n_docs_before + rows[-1].n_docs) if rows else 0
        self.folder = folder

    def __len__(self) -> int:
        return self.n_docs

    def __getitem__(self, k: int) -> np.ndarray:
        if not 0 <= k < self.n_docs:
            raise IndexError(k)
        part = int(np.searchsorted(self.first, k, side="right")) - 1
        name, width = self.parts[part]
        a, b = mapped(f"{self.folder}/{name}.offsets", "<u8")[k - self.first[part]: k - self.first[part] + 2]
        return mapped(f"{self.folder}/{name}.ids", f"<u{width}")[int(a): int(b)]
