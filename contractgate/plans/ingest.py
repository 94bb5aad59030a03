"""Jobs: ingest (source -> raw / dead-letter), stage (raw -> typed), run (audited
ingest + stage), and the watermark report.

Ingest, per entity:

1. list ``<source>/<entity>/*.csv|*.parquet`` with Spark's file index;
2. read every file's header (CSV) or footer schema (Parquet) and group files
   that share one; each group is one scan, so no file is read with another
   file's header;
3. validate all groups of all entities in one Spark job (a union of one-pass
   aggregates, batch = source file) and collect the manifests: one small row
   per file;
   (CSV files are first parsed into Parquet in the work folder, once);
4. accepted files are landed in raw, rejected files in the dead-letter zone, each
   replacing the partition of its file; error manifests are written beside the
   dead-letter data;
5. the watermark of each entity with an accepted file is advanced.

No data row reaches the driver; only the per-file verdicts do.
"""

from __future__ import annotations

import datetime as dt
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.contract import Contract, available_contracts, load_contract
from ..operators.project import apply_contract_types, coercion_exprs
from ..operators.route import maybe_broadcast
from ..operators.state import LoadLog, WatermarkStore, watermark_report as _wm_report
from ..operators.validate import empty_batch_manifest, validate
from ..session import work_dir
from ..sinks.zones import (
    DEAD_LETTER, EXTRA, OPEN_FILES, RAW_PARTS, SOURCE_FILE, as_date, current_loads, date_parts, entity_root, has_records, land,
    partition_rows, partitioned_key, replace_with_empty, store_names, write_manifests, write_staged,
)
from ..sources.files import (
    SourceFile, check_formats, group_files, list_source_files, made_visible,
)
from ..sources.scans import (
    files_with_quoted_newlines, raw_frames, read_csv_auto, read_parquet_files, union_as_text,
)

log = logging.getLogger("contractgate.jobs")

# header / schema groups validated per Spark job, and parsed at a time
GROUPS_PER_JOB = 64
HOLD_THREADS = 8

LOAD_MANIFEST_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("accepted", T.BooleanType()),
    T.StructField("rows", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("n_violations", T.LongType()),
    T.StructField("manifest_json", T.StringType()),
])

STAGE_MANIFEST_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("source_key", T.StringType()),
    T.StructField("target_key", T.StringType()),
    T.StructField("coerced", T.MapType(T.StringType(), T.LongType())),
])


def stage_manifest(spark: SparkSession, results: list[dict]) -> DataFrame:
    """The stage results as a DataFrame (one row per source file)."""
    return spark.createDataFrame([tuple(r[f.name] for f in STAGE_MANIFEST_SCHEMA.fields) for r in results],
                                 STAGE_MANIFEST_SCHEMA)


def staged_total(manifest: DataFrame) -> DataFrame:
    """Rows written to staged per entity and in total (AGG-6)."""
    return manifest.rollup("entity").agg(F.sum("rows").cast("bigint").alias("rows"))


@dataclass
class _Group:
    entity: str
    contract: Contract
    fmt: str
    names: list[str]
    files: list[SourceFile]

    needs_multi_line: set | None = None
    rules: list | None = None
    held: DataFrame | None = None

    def hold(self, spark: SparkSession, multi_line) -> None:
        """Parse the CSV files once, into Parquet in the work folder: validation
        then reads only the columns a rule needs, landing reads no CSV again."""
        df = read_csv_auto(spark, [f.path for f in self.files], self.names, multi_line, self.needs_multi_line)
        path = work_dir(spark, "held", fresh=True)
        df.write.parquet(path)
        self.held = spark.read.schema(df.schema).parquet(path)

    def scan(self, spark: SparkSession, files: list[SourceFile] | None = None) -> DataFrame:
        if self.fmt == "csv":
            if files is None or len(files) == len(self.files):
                return self.held
            names = spark.createDataFrame([(f.name,) for f in files], f"{SOURCE_FILE} string")
            return self.held.join(maybe_broadcast(names), SOURCE_FILE, "left_semi")
        paths = [f.path for f in (self.files if files is None else files)]
        if not self.names:  # 0-byte Parquet file: nothing to read
            schema = T.StructType([T.StructField(SOURCE_FILE, T.StringType())])
            return spark.createDataFrame([], schema)
        return read_parquet_files(spark, paths)


@dataclass
class IngestOutcome:
    manifest: list[dict] = field(default_factory=list)  # one dict per file
    skipped_entities: list[str] = field(default_factory=list)

    @property
    def accepted(self) -> list[dict]:
        return [m for m in self.manifest if m["accepted"]]

    @property
    def rejected(self) -> list[dict]:
        return [m for m in self.manifest if not m["accepted"]]

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [tuple(m[f.name] for f in LOAD_MANIFEST_SCHEMA.fields) for m in self.manifest]
        return spark.createDataFrame(rows, LOAD_MANIFEST_SCHEMA)


def summary(manifest: DataFrame) -> DataFrame:
    """``ACCEPTED entity: n rows -> key`` per file."""
    state = F.when(F.col("accepted"), F.lit("ACCEPTED")).otherwise(F.lit("REJECTED"))
    return manifest.select(
        "entity", "source_file",
        F.format_string("%s %s: %,d rows -> %s", state, F.col("entity"), F.col("rows"), F.col("key")).alias("summary"),
    )


def totals(manifest: DataFrame) -> DataFrame:
    """Accepted and rejected file counts and rows of a run."""
    return manifest.groupBy("accepted").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").cast("bigint").alias("rows"))


def _contracts_for(entities: list[str], contracts_dir) -> tuple[dict[str, Contract], list[str]]:
    found, skipped = {}, []
    for e in entities:
        try:
            found[e] = load_contract(e, contracts_dir)
        except FileNotFoundError:
            log.warning("%s has no contract: its files stay where they are", e)
            skipped.append(e)
    return found, skipped


def _groups(spark: SparkSession, files: list[SourceFile], contracts: dict[str, Contract]) -> list[_Group]:
    out = []
    for key, (names, members) in group_files(spark, files).items():
        fmt = key.split(":", 1)[0]
        by_entity: dict[str, list[SourceFile]] = {}
        for f in members:
            by_entity.setdefault(f.entity, []).append(f)
        for entity, fs in by_entity.items():
            out.append(_Group(entity, contracts[entity], fmt, names, fs))
    return out


def _validate_groups(spark: SparkSession, groups: list[_Group]) -> list[dict]:
    """One job: the manifests of every file of every group.

    A file with no data rows (header only, or 0 bytes) has no row in the
    aggregate; its verdict follows from the schema rules alone and is completed
    on the driver, so no list of files is embedded in the plan.
    """
    frames = []
    for g in groups:
        df = g.scan(spark)
        v = validate(df, g.contract, [SOURCE_FILE], actual=g.names, extra_column=EXTRA if g.fmt == "csv" else None)
        frames.append(v.manifest().select(
            F.lit(g.entity).alias("entity"), SOURCE_FILE, "row_count", "is_valid", "n_violations", "manifest_json"))
        g.rules = v.rules
    rows = []
    # many header groups (schema drift) are validated in a few jobs of bounded
    # plan size rather than one union of every group
    for start in range(0, len(frames), GROUPS_PER_JOB):
        chunk = frames[start:start + GROUPS_PER_JOB]
        union = chunk[0]
        for f in chunk[1:]:
            union = union.unionByName(f)
        rows.extend(r.asDict() for r in union.collect())
    seen = {(r["entity"], r[SOURCE_FILE]) for r in rows}
    for g in groups:
        empty = empty_batch_manifest(g.contract, g.rules)
        for f in g.files:
            if (g.entity, f.name) not in seen:
                rows.append({**empty, SOURCE_FILE: f.name, "entity": g.entity})
    return rows


def ingest(
    spark: SparkSession,
    source_dir: str,
    raw_root: str,
    load_date: dt.date | str,
    entities: list[str] | None = None,
    contracts_dir: str | Path | None = None,
    advance_watermark: bool = True,
    multi_line: bool | str = "auto",
    watermarks: WatermarkStore | None = None,
) -> IngestOutcome:
    """Validate every source file and land it in raw or the dead-letter zone."""
    files = list_source_files(spark, source_dir, entities)
    return ingest_files(spark, files, raw_root, load_date, contracts_dir, advance_watermark, multi_line, watermarks)


def ingest_files(
    spark: SparkSession,
    files: list[SourceFile],
    raw_root: str,
    load_date: dt.date | str,
    contracts_dir: str | Path | None = None,
    advance_watermark: bool = True,
    multi_line: bool | str = "auto",
    watermarks: WatermarkStore | None = None,
) -> IngestOutcome:
    """The gate for an explicit list of files (used by the batch and the
    streaming ingest)."""
    load_date = as_date(load_date)
    check_formats(files)
    present = sorted({f.entity for f in files})
    contracts, skipped = _contracts_for(present, contracts_dir)
    files = [f for f in files if f.entity in contracts]
    outcome = IngestOutcome(skipped_entities=skipped)
    if not files:
        return outcome

    files = made_visible(spark, files)
    groups = _groups(spark, files, contracts)
    if multi_line == "auto":
        needs = files_with_quoted_newlines(spark, [f.path for f in files if f.fmt == "csv"])
        for g in groups:
            g.needs_multi_line = needs
    with ThreadPoolExecutor(HOLD_THREADS) as pool:
        list(pool.map(lambda g: g.hold(spark, multi_line), [g for g in groups if g.fmt == "csv"]))
    verdicts = {(r["entity"], r[SOURCE_FILE]): r for r in _validate_groups(spark, groups)}

    # accepted CSV files hold exactly the contract's columns as text, whatever
    # their header order: one landing write per entity for all their groups
    merged_csv: dict[str, list] = {}
    for g in groups:
        ok = [f for f in g.files if verdicts[(g.entity, f.name)]["is_valid"]]
        if ok and g.fmt == "csv":
            merged_csv.setdefault(g.entity, []).append((g, ok))
        elif ok:
            _land_files(spark, g, ok, raw_root, load_date, verdicts, dead_letter=False)
    for entity, parts in merged_csv.items():
        frames = [g.scan(spark, ok).drop(EXTRA) for g, ok in parts]
        df = frames[0]
        for f in frames[1:]:
            df = df.unionByName(f)
        landed = [f for _, ok in parts for f in ok]
        _land_frame(spark, df, entity, landed, raw_root, load_date, verdicts, dead_letter=False)

    for g in groups:
        bad = [f for f in g.files if not verdicts[(g.entity, f.name)]["is_valid"]]
        if bad:
            _land_files(spark, g, bad, raw_root, load_date, verdicts, dead_letter=True)
            rows = [(verdicts[(g.entity, f.name)]["manifest_json"], f.name) for f in bad]
            mdf = spark.createDataFrame(rows, f"manifest_json string, {SOURCE_FILE} string")
            names = [tuple({**date_parts(load_date), "source_file": f.name}.values()) for f in bad]
            write_manifests(mdf, raw_root, g.entity, load_date, partitions=partition_rows(spark, RAW_PARTS, names))

    for f in sorted(files, key=lambda x: (x.entity, x.name)):
        r = verdicts[(f.entity, f.name)]
        key = partitioned_key(f.entity, load_date, f.name)
        outcome.manifest.append({
            "entity": f.entity, "source_file": f.name, "accepted": bool(r["is_valid"]),
            "rows": int(r["row_count"]), "key": key if r["is_valid"] else f"{DEAD_LETTER}/{key}",
            "n_violations": int(r["n_violations"]), "manifest_json": r["manifest_json"],
        })
        log.info("%s %s: %d rows -> %s", "ACCEPTED" if r["is_valid"] else "REJECTED", f.entity,
                 r["row_count"], outcome.manifest[-1]["key"])

    if advance_watermark and outcome.accepted:
        store = watermarks or WatermarkStore(spark, raw_root)
        for entity in sorted({m["entity"] for m in outcome.accepted}):
            store.advance(entity, load_date)
    return outcome


def _land_files(spark, g: _Group, files: list[SourceFile], root: str, load_date: dt.date,
                verdicts: dict, dead_letter: bool) -> None:
    df = g.scan(spark, files)
    if g.fmt == "csv" and not dead_letter:
        df = df.drop(EXTRA)  # accepted files have no extra fields
    _land_frame(spark, df, g.entity, files, root, load_date, verdicts, dead_letter)


def _land_frame(spark, df: DataFrame, entity: str, files: list[SourceFile], root: str, load_date: dt.date,
                verdicts: dict, dead_letter: bool) -> None:
    nonempty = [f for f in files if verdicts[(entity, f.name)]["row_count"] > 0]
    keys = {f.name: {**date_parts(load_date), "source_file": f.name} for f in files}
    if nonempty:
        written = partition_rows(spark, RAW_PARTS, [tuple(keys[f.name].values()) for f in nonempty])
        land(df, root, entity, load_date, SOURCE_FILE, dead_letter=dead_letter, partitions=written, open_files=OPEN_FILES)
    # zero rows: replace whatever an earlier load left at these keys
    empty = [keys[f.name] for f in files if verdicts[(entity, f.name)]["row_count"] == 0]
    replace_with_empty(spark, store_names(df.drop(SOURCE_FILE)).schema, entity_root(root, entity, dead_letter), empty)


def stage(
    spark: SparkSession,
    raw_root: str,
    staged_root: str,
    load_date: dt.date | str,
    entities: list[str] | None = None,
    contracts_dir: str | Path | None = None,
    report_coercions: bool = True,
) -> list[dict]:
    """Type one day of raw data per entity and write it to the staged zone.

    The staged partition of a day is the union of all raw files of that day.
    Returns one stage-manifest row per source file. ``report_coercions`` adds
    the count of values typing turned into null, per column; it re-reads the
    contracted columns of the day, while the row counts alone need only Parquet
    metadata.
    """
    load_date = as_date(load_date)
    names = entities or available_contracts(contracts_dir)
    contracts, _ = _contracts_for(names, contracts_dir)
    results = []
    for entity, contract in contracts.items():
        frames = raw_frames(spark, raw_root, entity, load_date)
        if not frames:
            log.warning("%s: the raw zone has no files of %s to stage", entity, load_date)
            continue
        # files of different types (CSV and Parquet, or Parquet of two widths) are typed
        # each in their own way; typed, they have the contract's types
        file_column = [_file_column(f) for f in frames]
        typed = union_as_text([
            apply_contract_types(f.drop(*(_part(f, p) for p in ("year", "month", "day"))), contract) for f in frames])
        target = partitioned_key(entity, load_date, "")
        # rows and silently coerced values per source file, in one aggregate
        counted: dict[str, dict] = {name: {"rows": 0} for name in landed_files(spark, raw_root, entity, load_date)}
        for f, column in zip(frames, file_column):
            coerced = coercion_exprs(f, contract, prefix="coerced:") if report_coercions else []
            for r in f.groupBy(column).agg(F.count(F.lit(1)).alias("rows"), *coerced).collect():
                counted[r[column]] = r.asDict()
        if any(r["rows"] for r in counted.values()):
            write_staged(typed, staged_root, entity, load_date)
        else:  # no rows are a day's content too: they replace what was staged before
            replace_with_empty(spark, store_names(typed).schema, f"{staged_root}/{entity}", [date_parts(load_date)])
        for name, r in sorted(counted.items()):
            results.append({"entity": entity, "rows": int(r["rows"]),
                            "source_key": partitioned_key(entity, load_date, name),
                            "target_key": target,
                            "coerced": {k.split(":", 1)[1]: int(v) for k, v in r.items()
                                        if k.startswith("coerced:") and v}})
    return results


def _part(frame: DataFrame, name: str) -> str:
    """The partition column ``name`` of a raw scan, whose name the data may have taken."""
    return f"load_{name}" if f"load_{name}" in frame.columns else name


def _file_column(frame: DataFrame) -> str:
    return _part(frame, "source_file")


def landed_files(spark: SparkSession, raw_root: str, entity: str, load_date: dt.date | str) -> list[str]:
    """Names of the files of one day in the raw zone, also those without rows."""
    base = entity_root(raw_root, entity)
    current = current_loads(spark, base, date_parts(load_date)) if has_records(spark, base) else None
    return sorted(r.source_file for r in current.select("source_file").toLocalIterator()) if current is not None else []


def run_load(
    spark: SparkSession,
    source_dir: str,
    raw_root: str,
    staged_root: str,
    load_date: dt.date | str,
    entities: list[str] | None = None,
    contracts_dir: str | Path | None = None,
    advance_watermark: bool = True,
    pipeline: str = "contractgate",
    load_log: LoadLog | None = None,
) -> tuple[IngestOutcome, list[dict]]:
    """Audited ingest, then stage only if nothing was rejected.

    A rejection marks the load ``failed`` and raises ``RuntimeError`` after the
    audit row is written; the row count logged is what was landed.
    """
    audit = load_log or LoadLog(spark, raw_root)
    staged: list[dict] = []
    with audit.audited(pipeline, "raw+staged") as load:
        outcome = ingest(spark, source_dir, raw_root, load_date, entities, contracts_dir, advance_watermark)
        if not outcome.rejected:
            staged = stage(spark, raw_root, staged_root, load_date, entities, contracts_dir)
        load.rows = sum(m["rows"] for m in outcome.accepted)
        if outcome.rejected:
            names = ", ".join(f"{m['entity']}/{m['source_file']}" for m in outcome.rejected)
            raise RuntimeError(f"not staged, as these files are quarantined: {names}")
    return outcome, staged


def watermark_report(spark: SparkSession, raw_root: str, entities: list[str] | None = None,
                     contracts_dir: str | Path | None = None) -> DataFrame:
    names = entities or available_contracts(contracts_dir)
    known = spark.createDataFrame([(e,) for e in names], "entity string")
    return _wm_report(known, WatermarkStore(spark, raw_root).current())
