"""Scans: strict CSV, Parquet, and the raw / staged zones.

CSV is read as received: every column a string, only an empty field is null
("NA", "nan" stay text), quotes doubled inside quoted fields, newlines allowed
inside quotes. The multi-line reader makes each file one task, so by default
(``multi_line="auto"``) a splittable pre-scan finds the files that have a quoted
newline and only those are read multi-line. One trailing ``_extra`` column catches rows
with more fields than the header instead of dropping the field in silence.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.route import batch_join, maybe_broadcast
from ..sinks.zones import (
    DATE_PARTS, EXTRA, LOAD, RAW_PARTS, SOURCE_FILE, current_loads, date_parts, entity_root, has_records, partition_path,
    restore_names,
)
from .files import VISIBLE, hadoop_fs, local_path, path_exists, physical_names, scan_path


def csv_options(multi_line: bool = True) -> dict[str, str]:
    return {
        "header": "true",
        "enforceSchema": "true",  # positional: the header was read per file
        "quote": '"',
        "escape": '"',
        "multiLine": "true" if multi_line else "false",
        "nullValue": "",
        "emptyValue": "",
        "mode": "PERMISSIVE",
        "encoding": "UTF-8",
    }


def _with_source(df: DataFrame) -> DataFrame:
    # Spark reports the name URL-encoded, with "+" as it is
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return df.withColumn(SOURCE_FILE, F.regexp_replace(name, f"^{VISIBLE}[0-9a-f]{{8}}-", ""))


def read_csv_strict(spark: SparkSession, paths: list[str], names: list[str], multi_line: bool = True,
                    with_source: bool = True) -> DataFrame:
    """All-string scan of CSV files that share the header ``names``.

    Columns are read by position and named afterwards, so a header may hold any
    names, also ones that differ only in case (see ``physical_names``).
    """
    schema = T.StructType([T.StructField(f"__c{i}", T.StringType(), True) for i in range(len(names))]
                          + [T.StructField(EXTRA, T.StringType(), True)])
    reader = spark.read.format("csv").schema(schema).options(**csv_options(multi_line))
    df = reader.load([scan_path(p) for p in paths])
    if with_source:
        df = _with_source(df)
    return df.toDF(*physical_names(names), *df.columns[len(names):])


def files_with_quoted_newlines(spark: SparkSession, paths: list[str]) -> set[str]:
    """Files that have a line with an odd number of quote characters, i.e. a
    quoted field that runs over a line end (or a stray quote). Only these need
    the unsplittable multi-line CSV reader. One splittable text scan."""
    if not paths:
        return set()
    quotes = F.length("value") - F.length(F.regexp_replace("value", '"', ""))
    rows = (
        spark.read.format("text").load([scan_path(p) for p in paths])
        .where(quotes % 2 == 1)
        .select(F.col("_metadata.file_path").alias("path"))
        .distinct()
        .collect()
    )
    return {local_path(r["path"], encoded=True) for r in rows}


def read_csv_auto(spark: SparkSession, paths: list[str], names: list[str], multi_line: bool | str = "auto",
                  needs_multi_line: set[str] | None = None) -> DataFrame:
    """Strict CSV scan. ``multi_line="auto"`` reads files without quoted
    newlines splittably and only the others with the multi-line reader, so one
    huge single-line file is still read by many tasks."""
    if multi_line != "auto":
        return read_csv_strict(spark, paths, names, multi_line=bool(multi_line))
    if needs_multi_line is None:
        needs_multi_line = files_with_quoted_newlines(spark, paths)
    ml = [p for p in paths if local_path(p) in needs_multi_line]
    sl = [p for p in paths if local_path(p) not in needs_multi_line]
    frames = []
    if sl:
        frames.append(read_csv_strict(spark, sl, names, multi_line=False))
    if ml:
        frames.append(read_csv_strict(spark, ml, names, multi_line=True))
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_parquet_files(spark: SparkSession, paths: list[str], with_source: bool = True) -> DataFrame:
    df = spark.read.format("parquet").load([scan_path(p) for p in paths])
    return _with_source(df) if with_source else df


def partition_frames(spark: SparkSession, base: str, parts: dict[str, str] | None = None, fmt: str = "parquet",
                     partition_columns: list[str] | None = None) -> list[DataFrame]:
    """Scans of a Hive-partitioned table, one per set of files whose columns
    have the same types; none when the path does not exist.

    Footers are merged by Spark (in executors), so a column that only some files
    have is read from those. Only where files give one column different types
    are the partition folders grouped by their own schemas. With ``parts`` only
    that folder is listed. Partition columns are declared as strings, so
    ``month=03`` stays the text "03".
    """
    path = partition_path(base, parts) if parts else base
    if not path_exists(spark, path):
        return []
    wanted = set(partition_columns or RAW_PARTS) | set(_partition_names(base, path)) | {LOAD}
    current, folders = None, [path]
    if has_records(spark, base):  # of each partition, the files of its current load
        current = current_loads(spark, base, parts)
        if current is None:
            return []
        if parts:  # the folders of one day (or month) are named, all others are not even listed
            folders = [scan_path(partition_path(base, r.asDict())) for r in current.toLocalIterator()]
            current = None
            if not folders:
                return []
        else:
            current = maybe_broadcast(current)

    def scan(paths: list[str], merge: bool) -> DataFrame:
        reader = lambda: spark.read.format(fmt).option("basePath", base)
        probe = reader().option("mergeSchema", str(merge).lower()).load(paths)
        data = [f for f in probe.schema.fields if f.name not in wanted]
        found = [n for n in probe.columns if n in wanted]
        schema = T.StructType(data + [T.StructField(n, T.StringType(), True) for n in found])
        df = reader().schema(schema).load(paths)
        if current is not None:
            df = batch_join(df, current, [n for n in found if n in current.columns])
        return restore_names(df.drop(LOAD))

    try:
        return [scan(folders, merge=fmt == "parquet")]
    except Exception as err:  # noqa: BLE001 - only a folder without files and a conflict of types are handled
        if "UNABLE_TO_INFER_SCHEMA" in str(err):
            return []
        if "MERGE_SCHEMA" not in str(err) and "CANNOT_MERGE" not in str(err) and "COLUMN_ALREADY_EXISTS" not in str(err):
            raise
    by_schema: dict[str, list[str]] = {}
    for folder in folders if folders != [path] else map(scan_path, _leaf_folders(spark, path)):
        by_schema.setdefault(spark.read.format(fmt).load(folder).schema.json(), []).append(folder)
    return [scan(folders, merge=False) for folders in by_schema.values()]


def _leaf_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders below ``path`` that hold data files."""
    p, fs = hadoop_fs(spark, path)
    files, out = fs.listFiles(p, True), set()
    while files.hasNext():
        f = files.next().getPath()
        if not str(f.getName()).startswith(("_", ".")):
            out.add(str(f.getParent().toString()))
    return sorted(out)


def read_partitioned(spark: SparkSession, base: str, parts: dict[str, str] | None = None,
                     fmt: str = "parquet", partition_columns: list[str] | None = None) -> DataFrame | None:
    """``partition_frames`` as one DataFrame; a column of differing types is text."""
    frames = partition_frames(spark, base, parts, fmt, partition_columns)
    return union_as_text(frames) if frames else None


def union_as_text(frames: list[DataFrame]) -> DataFrame:
    kinds: dict[str, set[str]] = {}
    for f in frames:
        for name, kind in f.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = {n for n, k in kinds.items() if len(k) > 1}
    out = None
    for f in frames:
        f = f.withColumns({n: F.col(f"`{n}`").cast("string") for n in f.columns if n in mixed})
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def _partition_names(base: str, path: str) -> list[str]:
    rel = path[len(base):].strip("/")
    return [seg.split("=", 1)[0] for seg in rel.split("/") if "=" in seg] if rel else []


def read_raw(spark: SparkSession, root: str, entity: str, load_date: dt.date | str | None = None,
             dead_letter: bool = False) -> DataFrame | None:
    """The raw (or dead-letter) zone of an entity, or one day of it."""
    frames = raw_frames(spark, root, entity, load_date, dead_letter)
    return union_as_text(frames) if frames else None


def raw_frames(spark: SparkSession, root: str, entity: str, load_date: dt.date | str | None = None,
               dead_letter: bool = False) -> list[DataFrame]:
    parts = date_parts(load_date) if load_date is not None else None
    return partition_frames(spark, entity_root(root, entity, dead_letter), parts, partition_columns=RAW_PARTS)


def read_staged(spark: SparkSession, staged_root: str, entity: str,
                load_date: dt.date | str | None = None) -> DataFrame | None:
    parts = date_parts(load_date) if load_date is not None else None
    return read_partitioned(spark, f"{staged_root}/{entity}", parts, partition_columns=DATE_PARTS)


__all__ = [
    "EXTRA", "SOURCE_FILE", "DATE_PARTS", "RAW_PARTS", "csv_options", "read_csv_strict",
    "read_parquet_files", "read_partitioned", "read_raw", "read_staged",
]
