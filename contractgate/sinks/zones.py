"""Zone layout and the partitioned sinks (raw, dead-letter, manifests, staged).

Layout (Hive style, partition values are zero-padded strings):

    <raw>/<entity>/year=YYYY/month=MM/day=DD/source_file=<name>/__load=<id>/part-*.parquet
    <raw>/_dead_letter/<entity>/year=.../source_file=<name>/__load=<id>/part-*.parquet
    <raw>/_dead_letter/_manifests/<entity>/year=.../source_file=<name>/__load=<id>/part-*.json
    <staged>/<entity>/year=YYYY/month=MM/day=DD/__load=<id>/part-*.parquet

Data columns may have any name: one that clashes with a partition column, or
with a column of the gate itself, is stored as ``__data_<name>`` and gets its
name back when the zone is read (the partition value is then called
``load_<name>``).

Loads and their records. Each write is a load with an id of its own; its files go
straight to their place, one level further down (``__load=<id>``), where nobody
sees them yet. When all are written, the load takes the next number and its
record, the list of its partitions, is moved to ``<zone>/_published/records/seq=<number>``
in one rename: that publishes it. A zone is read through its records: of each
partition the files of the load with the highest number. A crash before the
rename leaves the old rows, one after it the new rows; nothing is deleted before
a load is published, and what it replaced is removed afterwards. What a crashed
load left behind is never read; ``vacuum`` removes it. Re-landing a batch so replaces
exactly the partitions it touches (file grain for raw, day grain for staged),
and re-running a load never duplicates.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.reconcile import check_reconciled
from ..operators.route import batch_join, maybe_broadcast
from ..session import work_dir
from ..sources.files import claim_number, hadoop_fs, path_exists, scan_path

DEAD_LETTER = "_dead_letter"
MANIFESTS = "_manifests"
DATE_PARTS = ["year", "month", "day"]
RAW_PARTS = DATE_PARTS + ["source_file"]
# Columns of the gate while data is in flight; contracts may not use such names.
SOURCE_FILE = "__source_file"  # a row's batch file
EXTRA = "__extra"  # fields of a CSV row beyond its header
DAY = "__day"  # a row's load date
STORED_EXTRA = "_extra"  # EXTRA as stored with quarantined rows
STORED = "__data_"
RESERVED = frozenset([*RAW_PARTS, STORED_EXTRA])


def store_names(df: DataFrame, reserved: frozenset[str] = RESERVED) -> DataFrame:
    """Data columns under names that can stand beside the partition columns."""
    return df.withColumnsRenamed({c: STORED + c for c in df.columns if c.lower() in reserved or c.startswith(STORED)})


def restore_names(df: DataFrame) -> DataFrame:
    """The inverse, for a zone as read back."""
    data = {c: c[len(STORED):] for c in df.columns if c.startswith(STORED)}
    taken = {c.lower() for c in data.values()}
    clash = {c: f"load_{c}" for c in df.columns if c.lower() in taken}
    return df.withColumnsRenamed(clash).withColumnsRenamed(data)


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


def date_parts(load_date: dt.date | str) -> dict[str, str]:
    d = as_date(load_date)
    return {"year": f"{d.year:04d}", "month": f"{d.month:02d}", "day": f"{d.day:02d}"}


def partitioned_key(entity: str, load_date: dt.date | str, filename: str = "") -> str:
    """``entity/year=YYYY/month=MM/day=DD/filename``: deterministic, so a re-run
    addresses the same place."""
    p = date_parts(load_date)
    return f"{entity}/year={p['year']}/month={p['month']}/day={p['day']}/{filename}"


def date_part_columns(load_date: dt.date | str | Column) -> dict[str, Column]:
    """year/month/day string columns from a literal date or a date column."""
    if isinstance(load_date, Column):
        return {
            "year": F.date_format(load_date, "yyyy"),
            "month": F.date_format(load_date, "MM"),
            "day": F.date_format(load_date, "dd"),
        }
    return {k: F.lit(v) for k, v in date_parts(load_date).items()}


def entity_root(root: str, entity: str, dead_letter: bool = False) -> str:
    return f"{root}/{DEAD_LETTER}/{entity}" if dead_letter else f"{root}/{entity}"


def manifest_root(root: str, entity: str) -> str:
    return f"{root}/{DEAD_LETTER}/{MANIFESTS}/{entity}"


def escaped(value: str) -> str:
    """A partition value as Spark writes it in a folder name."""
    return re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


def partition_path(base: str, parts: dict[str, str | None]) -> str:
    return base + "".join(f"/{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else escaped(v)}" for k, v in parts.items())


# A load's files, and the records of published loads.
LOAD = "__load"
PUBLISHED = "_published"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Folders handled at a time.
FOLDER_THREADS = 16
# Files a task of a load of file batches holds open, so that it need not sort its rows by file; beyond, it sorts the rest.
OPEN_FILES = 4
_OPEN_FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def _records_path(path: str) -> str:
    return f"{path}/{PUBLISHED}/records"


def begin_load(spark: SparkSession, path: str) -> str:
    """The id of a new load. From the first load on, a zone is read by its records only."""
    p, fs = hadoop_fs(spark, f"{path}/{PUBLISHED}")
    fs.mkdirs(p)
    return uuid.uuid4().hex[:16]


def has_records(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{PUBLISHED}")


def current_loads(spark: SparkSession, path: str, parts: dict[str, str] | None = None) -> DataFrame | None:
    """Partition columns and ``__load`` of every published partition (of those in
    ``parts``); None if nothing was published."""
    if not path_exists(spark, _records_path(path)):
        return None
    records = spark.read.orc(_records_path(path))
    for name, value in (parts or {}).items():
        records = records.where(F.col(name) == value)
    keys = [c for c in records.columns if c not in (LOAD, "seq")]
    return records.groupBy(*keys).agg(F.max_by(LOAD, "seq").alias(LOAD))


def publish(spark: SparkSession, path: str, load: str, partitions: DataFrame) -> None:
    """Make ``load`` the current one of ``partitions`` (rows of partition values), then remove what it replaced."""
    keys = partitions.columns
    before = current_loads(spark, path)
    new = f"{path}/{PUBLISHED}/_new-{load}"
    partitions.withColumn(LOAD, F.lit(load)).write.orc(new)
    if before is not None:  # as it was, fixed before the load takes effect
        before = spark.read.schema(before.schema).orc(_saved(before, f"{path}/{PUBLISHED}/_old-{load}"))
    seq = claim_number(spark, f"{path}/{PUBLISHED}/claims")
    top, fs = hadoop_fs(spark, f"{_records_path(path)}/seq={seq}")
    fs.mkdirs(top.getParent())
    if not fs.rename(hadoop_fs(spark, new)[0], top):
        raise OSError(f"cannot publish load {load} in {path}")
    if before is not None:
        replaced = batch_join(before, maybe_broadcast(partitions), keys)
        _remove(spark, (_load_folder(path, r.asDict()) for r in replaced.toLocalIterator()))
        _remove(spark, [f"{path}/{PUBLISHED}/_old-{load}"])


def _saved(df: DataFrame, path: str) -> str:
    df.write.orc(path)
    return path


def _load_folder(path: str, values: dict[str, str | None]) -> str:
    return partition_path(path, values)


def _remove(spark: SparkSession, folders: Iterable[str]) -> None:
    def remove(folder: str) -> None:
        p, fs = hadoop_fs(spark, folder)
        fs.delete(p, True)

    with ThreadPoolExecutor(FOLDER_THREADS) as pool:
        for _ in pool.map(remove, folders):
            pass


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove the files of loads that are not current: replaced ones, and those of
    writers that ended before they published. Run it while no load is being
    written. Returns the number of folders removed."""
    current = current_loads(spark, path)
    kept = {_load_folder("", r.asDict()) for r in current.toLocalIterator()} if current is not None else set()
    p, fs = hadoop_fs(spark, path)
    base, files, found = str(p.toUri().getPath()), fs.listFiles(p, True), set()
    while files.hasNext():
        folder = str(files.next().getPath().getParent().toUri().getPath())
        if f"/{LOAD}=" in folder and "/_temporary/" not in folder:
            found.add(folder[folder.index(base) + len(base):])
    gone = [path + f for f in found if f not in kept]
    _remove(spark, gone + [f"{path}/_temporary"])
    return len(gone)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], rebalance: bool = False,
                      fmt: str = "parquet", partitions: DataFrame | None = None, reconciled: bool = False,
                      open_files: int = 0) -> None:
    """Replace the partitions of ``path`` that occur in ``df``. ``rebalance``:
    shuffle rows so that each output partition is written by few tasks; use it
    when rows of one partition are spread over every input task. Batches that
    are files are already clustered and need no shuffle. ``partitions``: the
    partition values in ``df``, where the caller knows them (else they are listed).
    ``reconciled``: the written rows are read again and compared with ``df``
    before the load is published (Parquet only); if they differ it is not.
    ``open_files``: how many files a task holds open instead of sorting its rows
    by partition; for tasks that meet few partitions, as those of file batches do."""
    spark = df.sparkSession
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    load = begin_load(spark, path)
    # tasks move their files to their place themselves, as nobody reads them before the load is published;
    # the folder of work in progress stays, as another load may be using it
    writer = (df.withColumn(LOAD, F.lit(load)).write.mode("append").partitionBy(*partition_by, LOAD)
              .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
              .option("mapreduce.fileoutputcommitter.cleanup.skipped", "true")
              .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"))
    held = spark.conf.get(_OPEN_FILES_CONF)
    spark.conf.set(_OPEN_FILES_CONF, str(open_files))
    try:
        if fmt == "json":
            writer.option("compression", "none").option("ignoreNullFields", "false").json(path)
        else:
            writer.option("compression", "snappy").parquet(path)
    finally:
        spark.conf.set(_OPEN_FILES_CONF, held)
    _tidy(spark, path, load)
    if reconciled:
        check_reconciled(df, _load_rows(spark, path, load, df, partition_by), partition_by)
    if partitions is None:
        partitions = _written(spark, path, load, partition_by)
    publish(spark, path, load, partitions.select(*[F.col(c).cast("string").alias(c) for c in partition_by]))


def _load_rows(spark: SparkSession, path: str, load: str, df: DataFrame, partition_by: list[str]) -> DataFrame:
    """The rows of a load that is not published yet."""
    found = "/".join([scan_path(path), *["*=*"] * len(partition_by), f"{LOAD}={load}"])
    if not _written(spark, path, load, partition_by).limit(1).count():
        return df.limit(0)
    values = ", ".join(f"`{c}` string" for c in [*partition_by, LOAD])
    schema = T.StructType([*(f for f in df.schema.fields if f.name not in partition_by), *T._parse_datatype_string(values).fields])
    return spark.read.schema(schema).option("basePath", path).parquet(found)


def _tidy(spark: SparkSession, path: str, load: str) -> None:
    """Remove a finished load's own folders of work in progress (empty by now), not those of other loads."""
    p, fs = hadoop_fs(spark, path)
    for attempt in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(p, "_temporary/*/_temporary/*")) or []:
        at = attempt.getPath()
        while not str(at.getName()).startswith(f"{LOAD}="):  # an attempt writes for one load: any branch tells which
            inside = [s.getPath() for s in fs.listStatus(at) if s.isDirectory()]
            if not inside:
                break
            at = inside[0]
        if str(at.getName()) == f"{LOAD}={load}":
            fs.delete(attempt.getPath(), True)


def _written(spark: SparkSession, path: str, load: str, partition_by: list[str]) -> DataFrame:
    """The partitions a load has written, from the names of its folders."""
    p, fs = hadoop_fs(spark, path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(p, "/".join(["*=*"] * len(partition_by) + [f"{LOAD}={load}"]))
    rows = []
    for status in fs.globStatus(pattern):
        names = str(status.getPath().toUri().getPath()).split("/")[-1 - len(partition_by):-1]
        values = [unquote(n.split("=", 1)[1]) for n in names]
        rows.append(tuple(None if v == NULL_PARTITION else v for v in values))
    return partition_rows(spark, partition_by, rows)


def partition_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).coalesce(1)


def _with_parts(df: DataFrame, load_date: dt.date | str | Column, source_file: str | Column | None) -> DataFrame:
    """``df`` as stored, with its partition columns."""
    parts = dict(date_part_columns(load_date))
    if source_file is not None:
        parts["source_file"] = F.col(source_file) if isinstance(source_file, str) else source_file
    found = df.withColumns({f"__part_{k}": v for k, v in parts.items()}).drop(SOURCE_FILE, DAY)
    reserved = RESERVED if source_file is not None else frozenset(DATE_PARTS)
    stored = store_names(found, reserved).withColumnsRenamed({f"__part_{k}": k for k in parts})
    return stored.withColumnRenamed(EXTRA, STORED_EXTRA)


def land(df: DataFrame, root: str, entity: str, load_date: dt.date | str | Column,
         source_file: str | Column = SOURCE_FILE, dead_letter: bool = False, rebalance: bool = False,
         partitions: DataFrame | None = None, reconciled: bool = False, open_files: int = 0) -> str:
    """Write a batch (or many) to the raw or dead-letter zone of ``entity``.

    ``load_date`` is a date for a whole load, or a column giving each row's day.
    ``source_file`` names the column (or gives the expression) of the batch file
    name, the last partition level: idempotency is at file grain. ``partitions``, ``reconciled``, ``open_files``: see ``write_partitioned``.
    """
    out = _with_parts(df, load_date, source_file)
    target = entity_root(root, entity, dead_letter)
    write_partitioned(out, target, RAW_PARTS, rebalance=rebalance, partitions=partitions, reconciled=reconciled, open_files=open_files)
    return target


def replace_with_empty(spark: SparkSession, df_schema, base: str, keys: list[dict[str, str]]) -> None:
    """Replace partitions of ``base`` with ones that hold no rows: a batch with zero
    rows still replaces what an earlier load left at its key. One job writes the
    empty file, which is then copied to each folder. A file with no columns at
    all (0 bytes) is marked by one empty placeholder column."""
    from pyspark.sql import types as T

    if not keys:
        return
    if not df_schema.fields:
        df_schema = T.StructType([T.StructField("_empty", T.StringType(), True)])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path
    model = hadoop(f"{work_dir(spark, 'empty', fresh=True)}")
    spark.createDataFrame([], df_schema).write.parquet(str(model.toString()))
    source, load = model.getFileSystem(conf), begin_load(spark, base)

    def write(key: dict[str, str]) -> None:
        target = hadoop(partition_path(base, {**key, LOAD: load}))
        fs = target.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        if not jvm.org.apache.hadoop.fs.FileUtil.copy(source, model, fs, target, False, conf):
            raise OSError(f"cannot write {target.toString()}")

    with ThreadPoolExecutor(FOLDER_THREADS) as pool:
        list(pool.map(write, keys))
    publish(spark, base, load, partition_rows(spark, list(keys[0]), [tuple(k.values()) for k in keys]))


def write_manifests(df: DataFrame, root: str, entity: str, load_date: dt.date | str | Column,
                    source_file: str | Column = SOURCE_FILE, partitions: DataFrame | None = None) -> str:
    """Error manifests of rejected batches, beside the dead-letter data."""
    target = manifest_root(root, entity)
    write_partitioned(_with_parts(df, load_date, source_file), target, RAW_PARTS, fmt="json", partitions=partitions)
    return target


def write_staged(df: DataFrame, staged_root: str, entity: str, load_date: dt.date | str | Column,
                 rebalance: bool = False) -> str:
    target = f"{staged_root}/{entity}"
    write_partitioned(_with_parts(df, load_date, None), target, DATE_PARTS, rebalance=rebalance,
                      open_files=0 if isinstance(load_date, Column) else OPEN_FILES)
    return target
