"""Gate a DataFrame whose batches are derived from a column (e.g. one batch per
day of a table), instead of one batch per source file.

Plan: one validation aggregate (batch = day + source file), whose verdicts and
manifests are written out as a table partitioned by the verdict. Routing, the
manifests, the publish records and the watermarks read that table; the driver
reads two counts and two sums. Accepted and rejected rows are joined with it
(broadcast when its measured size allows it) and dealt to as many write tasks
as there are files and rows to write: small days share a task, a hot day is
split by its row count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contract import Contract
from ..operators.route import batch_join, maybe_broadcast
from ..operators.state import LOAD_LOG_SCHEMA, WatermarkStore
from ..operators.validate import validate
from ..session import work_dir
from ..sinks.zones import DAY, SOURCE_FILE, date_part_columns, land, write_manifests


# A batch is written as one file per so many rows, and a task writes so many files, of about so many rows in all.
ROWS_PER_FILE = 2_000_000
FILES_PER_TASK = 32
ROWS_PER_TASK = 500_000
FILES = "__files"


def dealt(df: DataFrame, keys: list[str], files: int, rows: int = 0) -> DataFrame:
    """``df`` (with the number of files of each row's batch) dealt to write tasks:
    as many as the numbers of files and rows ask for; a batch of several files is dealt
    over as many tasks, so a hot day is not one task's work."""
    # by a hash of the row, which a task that is run again gives again
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not _is_map(df, c)]), F.col(FILES))
    return df.withColumn(FILES, part).repartition(max(1, -(-files // FILES_PER_TASK), -(-rows // ROWS_PER_TASK)), *keys, FILES).drop(FILES)


def _is_map(df: DataFrame, column: str) -> bool:
    return "map<" in df.schema[column].dataType.simpleString()  # maps have no hash


@dataclass
class BatchGate:
    table: DataFrame  # written: one row per (day, source file) with its verdict and manifest
    n_accepted: int
    n_rejected: int

    @property
    def accepted(self) -> DataFrame:
        return self.table.where("is_valid")

    @property
    def rejected(self) -> DataFrame:
        return self.table.where("NOT is_valid")

    @property
    def verdicts(self) -> list[dict]:
        """All verdicts on the driver: for looking at a gate of few batches; no job calls this."""
        return [r.asDict() for r in self.table.collect()]


def with_batches(df: DataFrame, day: Column, source_file: Column | None = None) -> DataFrame:
    sf = source_file if source_file is not None else F.col("_metadata.file_name")
    return df.withColumns({DAY: day.cast("date"), SOURCE_FILE: sf})


def gate_by_day(spark: SparkSession, df: DataFrame, contract: Contract, raw_root: str, entity: str, reconciled: bool = False) -> BatchGate:
    """Validate, route and land ``df`` (as from ``with_batches``), accepted and
    rejected rows alike; returns the verdict of every batch. ``reconciled``: landed
    rows are compared with the received ones before they are published."""
    keys = [DAY, SOURCE_FILE]
    manifest = validate(df, contract, keys).manifest()
    path = work_dir(spark, "verdicts", fresh=True)
    manifest.write.partitionBy("is_valid").parquet(path)
    table = spark.read.schema(manifest.schema).parquet(path).select(*manifest.columns)
    files = F.ceil(F.col("row_count") / ROWS_PER_FILE).cast("bigint")
    found = {r.is_valid: r for r in table.groupBy("is_valid").agg(F.count(F.lit(1)).alias("n"), F.sum(files).alias("files"), F.sum("row_count").alias("rows")).collect()}
    gate = BatchGate(table, *(found[v].n if v in found else 0 for v in (True, False)))
    for valid, batches in ((True, gate.accepted), (False, gate.rejected)):
        if valid not in found:
            continue
        rows = batch_join(df, maybe_broadcast(batches.select(*keys, files.alias(FILES))), keys, "inner")
        parts = batches.select(*[c.alias(n) for n, c in {**date_part_columns(F.col(DAY)), "source_file": F.col(SOURCE_FILE)}.items()])
        land(dealt(rows, keys, found[valid].files, found[valid].rows), raw_root, entity, F.col(DAY), dead_letter=not valid, partitions=parts, reconciled=reconciled)
        if not valid:
            write_manifests(batches.repartition(-(-gate.n_rejected // FILES_PER_TASK)), raw_root, entity, F.col(DAY), partitions=parts)
    return gate


def advance_from_gate(spark: SparkSession, store: WatermarkStore, entity: str, gate: BatchGate) -> None:
    """One advance event per accepted day, appended in one write."""
    store.advance_many(gate.accepted.where(F.col(DAY).isNotNull()).select(F.lit(entity).alias("entity"), F.col(DAY).alias("watermark")))


def load_events(verdicts: DataFrame, pipeline: str, target_table: str, batch: str) -> DataFrame:
    """Load-log events of one audited load per batch: a ``running`` start and a
    ``success`` / ``failed`` finish, built from the verdict table."""
    now = F.current_timestamp().cast("timestamp_ntz")
    load_id = F.concat_ws(":", F.lit(pipeline), F.lit(target_table), F.col(batch))
    start = verdicts.select(
        load_id.alias("load_id"), F.lit(pipeline).alias("pipeline"), F.lit(target_table).alias("target_table"),
        F.lit("running").alias("status"), F.lit(None).cast("bigint").alias("rows_loaded"), now.alias("event_at"))
    finish = verdicts.select(
        load_id.alias("load_id"), F.lit(None).cast("string").alias("pipeline"),
        F.lit(None).cast("string").alias("target_table"),
        F.when(F.col("is_valid"), F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.when(F.col("is_valid"), F.col("row_count")).otherwise(F.lit(0)).cast("bigint").alias("rows_loaded"),
        (now + F.expr("INTERVAL 1 MICROSECOND")).alias("event_at"))
    return start.unionByName(finish).select(*[f.name for f in LOAD_LOG_SCHEMA.fields])
