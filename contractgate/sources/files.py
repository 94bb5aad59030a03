"""Source discovery and per-file column names.

Files are listed through the Hadoop file system, entity folder by entity folder.
A CSV header is the first record of a file and a Parquet schema is in its
footer: both are read per file, a few bytes each, so that files with different
headers are never scanned with one shared header (Spark would apply the first
file's header to all and swap values in silence).
"""

from __future__ import annotations

import csv
import io
import logging
import os
import re
import uuid
from collections import OrderedDict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..session import work_dir

log = logging.getLogger("contractgate.sources")

FORMATS = {"csv": "csv", "parquet": "parquet"}
HEADER_CHUNK = 64 * 1024
HEADER_THREADS = 16
# Files of claimed numbers that stay in their folder.
CLAIMS_KEPT = 100
# Spark's file sources pass over names that begin with "_" or "."; such source
# files are read from a copy whose name begins with this and eight hex digits.
VISIBLE = "contractgate-visible-"


@dataclass(frozen=True)
class SourceFile:
    entity: str
    path: str  # full path, not URL-encoded
    name: str  # file name: the batch key
    fmt: str  # csv | parquet
    size: int = -1


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def claim_number(spark: SparkSession, folder: str, floor: int = 0) -> int:
    """The next number of ``folder`` (above ``floor``), which no other writer gets: a file of
    that name is created, and only one creation of a name succeeds. Numbers so follow the
    order of the calls, whatever the writers' clocks say."""
    p, fs = hadoop_fs(spark, folder)
    fs.mkdirs(p)
    local = str(fs.getUri().getScheme()) == "file"
    taken = sorted(int(n) for n in (str(s.getPath().getName()) for s in fs.listStatus(p)) if n.isdigit())
    n = max([floor, *taken[-1:]]) + 1
    while True:
        name = spark._jvm.org.apache.hadoop.fs.Path(p, f"{n:015d}")
        try:
            if local:  # the Java API of a local file system looks first and creates then
                os.close(os.open(str(name.toUri().getPath()), os.O_CREAT | os.O_EXCL))
            else:
                fs.create(name, False).close()
            break
        except FileExistsError:
            n += 1
        except Py4JJavaError as err:
            if "AlreadyExists" not in str(err.java_exception.getClass().getName()):
                raise
            n += 1
    for old in taken[:-CLAIMS_KEPT]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(p, f"{old:015d}"), False)
    return n


def format_of(name: str) -> str | None:
    suffix = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    return FORMATS.get(suffix)


def local_path(path: str, encoded: bool = False) -> str:
    """A path without scheme and host. ``encoded``: as Spark reports it, URL-encoded."""
    plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "", path)
    return unquote(plain) if encoded else plain


def scan_path(path: str) -> str:
    """A path for a reader's ``load``, which takes glob characters literally only when escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def list_source_files(spark: SparkSession, source_dir: str, entities: list[str] | None = None) -> list[SourceFile]:
    """``<source_dir>/<entity>/<file>.csv|.parquet``, sorted by entity then file.

    ``entities`` None or empty means all. Every name counts, also ones that need
    quoting or begin with "_" or "."; a 0-byte file is listed too.
    """
    base = source_dir.rstrip("/")
    p, fs = hadoop_fs(spark, base)
    if not fs.exists(p):
        raise FileNotFoundError(f"source directory not found: {source_dir}")
    out = []
    for folder in fs.listStatus(p):
        entity = str(folder.getPath().getName())
        if not folder.isDirectory() or (entities and entity not in entities):
            continue
        found = [SourceFile(entity, str(s.getPath().toString()), str(s.getPath().getName()), format_of(str(s.getPath().getName())), s.getLen())
                 for s in fs.listStatus(folder.getPath()) if s.isFile()]
        found = [f for f in found if f.fmt is not None and not f.name.endswith(".crc")]
        out.extend(found)
        if not found and not entity.startswith(("_", ".")):
            log.warning("ingest: no data files for entity %s", entity)
    return sorted(out, key=lambda f: (f.entity, f.name))


def made_visible(spark: SparkSession, files: list[SourceFile]) -> list[SourceFile]:
    """``files`` with paths that Spark's readers accept: those with hidden names
    are copied to the work folder (and stay where they are)."""
    out = []
    for f in files:
        if f.name.startswith(("_", ".")):
            src, src_fs = hadoop_fs(spark, f.path)
            copy, fs = hadoop_fs(spark, f"{work_dir(spark, 'visible', fresh=True)}/{VISIBLE}{uuid.uuid4().hex[:8]}-{f.name}")
            if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(src_fs, src, fs, copy, False, spark._jsc.hadoopConfiguration()):
                raise OSError(f"cannot copy {f.path}")
            f = replace(f, path=str(fs.makeQualified(copy).toString()))
        out.append(f)
    return out


def check_formats(files: list[SourceFile]) -> None:
    bad = sorted({f.name for f in files if f.fmt not in FORMATS.values()})
    if bad:
        raise ValueError(f"neither CSV nor Parquet: {bad}")


def _first_record(spark: SparkSession, path: str) -> bytes:
    """The first CSV record of a file that is not blank, however long."""
    p, fs = hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        record, quoted = bytearray(), False
        while chunk := bytes(stream.readNBytes(HEADER_CHUNK)):
            for line in re.split(b"(\r\n|\r|\n)", chunk):
                ends = line in (b"\r\n", b"\r", b"\n")
                if ends and not quoted:
                    if record.removeprefix(b"\xef\xbb\xbf").strip():
                        return bytes(record)
                    record.clear()  # a blank line before the header
                    continue
                record += line
                quoted ^= line.count(b'"') % 2 == 1  # a doubled quote changes it twice
        return bytes(record)
    finally:
        stream.close()


def mangle_names(names: list[str]) -> list[str]:
    """Header names as a DataFrame library would expose them: an empty name
    becomes ``Unnamed: <i>``, a repeated name gets ``.1``, ``.2``, ..."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for i, n in enumerate(names):
        n = n if n != "" else f"Unnamed: {i}"
        if n in seen:
            k = seen[n]
            cand = f"{n}.{k}"
            while cand in seen:
                k += 1
                cand = f"{n}.{k}"
            seen[n] = k + 1
            seen[cand] = 1
            n = cand
        else:
            seen[n] = 1
        out.append(n)
    return out


def physical_names(names: list[str]) -> list[str]:
    """Column names for a scan: as received, but a name that repeats an earlier
    one in another case gets a number (Spark could not tell them apart)."""
    out, seen = [], {n.lower() for n in names}
    used: set[str] = set()
    for n in names:
        k, name = 1, n
        while name.lower() in used:
            name = f"{n}.{k}"
            k += 1
            if name.lower() in seen and name.lower() not in used:
                continue
        used.add(name.lower())
        out.append(name)
    return out


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file; [] for one without any line."""
    text = _first_record(spark, path).decode("utf-8", errors="replace").removeprefix("\ufeff")
    if not text.strip():
        return []
    return mangle_names(next(csv.reader(io.StringIO(text, newline=""), delimiter=",", quotechar='"', doublequote=True)))


def parquet_schema(spark: SparkSession, path: str) -> tuple[list[str], str]:
    """(column names, schema text) from a Parquet footer."""
    jvm = spark._jvm
    p, _ = hadoop_fs(spark, path)
    jfile = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(p, spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jfile)
    try:
        schema = reader.getFooter().getFileMetaData().getSchema()
        names = [f.getName() for f in schema.getFields()]
        return names, str(schema.toString())
    finally:
        reader.close()


def file_columns(spark: SparkSession, files: list[SourceFile]) -> dict[str, tuple[list[str], str]]:
    """path -> (received column names, grouping key) for every file, read the same
    way for any number of files: a header or a footer each, a few threads at once."""
    def one(f: SourceFile):
        if f.fmt == "csv":
            names = csv_header(spark, f.path)
            return f.path, (names, "csv:" + "\x1f".join(names))
        p, fs = hadoop_fs(spark, f.path)
        if fs.getFileStatus(p).getLen() == 0:
            return f.path, ([], "parquet:<empty>")
        names, text = parquet_schema(spark, f.path)
        return f.path, (names, "parquet:" + text)

    if len(files) <= 1:
        return dict(map(one, files))
    with ThreadPoolExecutor(max_workers=min(HEADER_THREADS, len(files))) as pool:
        return dict(pool.map(one, files))


def group_files(spark: SparkSession, files: list[SourceFile]) -> "OrderedDict[str, tuple[list[str], list[SourceFile]]]":
    """Files grouped by (format, received columns): one scan per group."""
    cols = file_columns(spark, files)
    groups: OrderedDict[str, tuple[list[str], list[SourceFile]]] = OrderedDict()
    for f in files:
        names, key = cols[f.path]
        groups.setdefault(key, (names, []))[1].append(f)
    return groups
