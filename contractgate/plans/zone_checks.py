"""Registered queries over the zones: landing, re-landing, dead-lettering,
staging, watermarks, the load log and CSV sources, all driven by the driver's
tables. Zones live under the session's checkpoint folder (see ``session``)."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contract import PACKAGE_CONTRACTS, Contract, available_contracts
from ..operators.project import apply_contract_types, coercion_counts
from ..operators.reconcile import reconciliation
from ..operators.state import LoadLog, WatermarkStore, stale_loads, watermark_report
from ..operators.validate import validate
from ..session import work_dir
from ..sources.files import hadoop_fs
from ..sources.scans import read_partitioned, read_raw, read_staged
from ..sinks.zones import DAY, SOURCE_FILE, manifest_root
from .batches import BatchGate, advance_from_gate, gate_by_day, load_events, with_batches
from .ingest import ingest, run_load, stage, stage_manifest, staged_total, summary, totals
from .tables import TPCH_CONTRACTS, table, tpch_contract

def _orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a CSV source would deliver them (all text), with a bad customer
    key every 97th order and an impossible date every 101st."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.cast("string").alias("o_orderkey"),
        F.when(key % 97 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.when(key % 101 == 0, F.lit("2020-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        "o_orderpriority",
    )


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed projection of text orders: bad values become null."""
    return apply_contract_types(_orders_as_text(spark, sf_dir), tpch_contract("orders"))


def coercions_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values typing turned into null, per contracted column."""
    return coercion_counts(_orders_as_text(spark, sf_dir), tpch_contract("orders"))


def _orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch per order month, loaded on the first day of that month."""
    return with_batches(table(spark, sf_dir, "orders"), F.trunc("o_orderdate", "month"))


def _landed_orders(spark: SparkSession, sf_dir: str) -> tuple[str, BatchGate]:
    """Gate orders with one batch per order month into a raw zone of its own."""
    root = work_dir(spark, "orders-by-month", fresh=True)
    return root, gate_by_day(spark, _orders_by_month(spark, sf_dir), tpch_contract("orders"), root, "orders")


def _latest_accepted_month(gate: BatchGate) -> dt.date | None:
    """None if every month was rejected."""
    return gate.accepted.agg(F.max(DAY)).first()[0]


_RAW_PARTS_SCHEMA = "year string, month string, day string, source_file string"
_MANIFEST_SCHEMA = "contract_version string, entity string, is_valid boolean, manifest_json string, n_violations bigint, row_count bigint"


def _empty_like(spark: SparkSession, df: DataFrame, extra: str) -> DataFrame:
    """No rows, with the columns a zone scan would have returned."""
    return spark.createDataFrame([], f"{', '.join(f'`{n}` {t}' for n, t in df.dtypes)}, {extra}")


def raw_orders_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest accepted month of the raw zone, read by partition (only that
    folder is listed)."""
    root, gate = _landed_orders(spark, sf_dir)
    month, df = _latest_accepted_month(gate), None
    if month is not None:
        df = read_partitioned(spark, f"{root}/orders", {"year": f"{month.year:04d}", "month": f"{month.month:02d}"})
    return df if df is not None else _empty_like(spark, table(spark, sf_dir, "orders"), _RAW_PARTS_SCHEMA)


def relanded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the same monthly batches three times: every row is there once."""
    root = work_dir(spark, "orders-reland", fresh=True)
    for _ in range(3):
        gate_by_day(spark, _orders_by_month(spark, sf_dir), tpch_contract("orders"), root, "orders")
    df = read_raw(spark, root, "orders")  # None: every month was rejected, each time
    return df if df is not None else _empty_like(spark, table(spark, sf_dir, "orders"), _RAW_PARTS_SCHEMA)


def reconciled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly batches landed with reconciliation, then both zones against what was received."""
    root = work_dir(spark, "orders-reconciled", fresh=True)
    received = _orders_by_month(spark, sf_dir)
    gate_by_day(spark, received, tpch_contract("orders"), root, "orders", reconciled=True)
    zones = [z for z in (read_raw(spark, root, "orders", dead_letter=d) for d in (False, True)) if z is not None]
    keys = ["year", "month", "source_file"]
    received = received.withColumns({"year": F.date_format(DAY, "yyyy"), "month": F.date_format(DAY, "MM"), "source_file": F.col(SOURCE_FILE)})
    landed = reduce(DataFrame.unionByName, zones)
    return reconciliation(received.drop(DAY, SOURCE_FILE), landed, keys).drop("source_file")


def dead_letter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the rejected months, as received, in the dead-letter zone."""
    df = read_raw(spark, _landed_orders(spark, sf_dir)[0], "orders", dead_letter=True)
    return df if df is not None else _empty_like(spark, table(spark, sf_dir, "orders"), _RAW_PARTS_SCHEMA)


def dead_letter_manifests_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error manifests beside the dead-letter data: one per rejected month."""
    df = read_partitioned(spark, manifest_root(_landed_orders(spark, sf_dir)[0], "orders"), fmt="json")
    return df if df is not None else spark.createDataFrame([], f"{_MANIFEST_SCHEMA}, {_RAW_PARTS_SCHEMA}")


def watermark_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward-only watermark after advancing once per accepted monthly load."""
    root = work_dir(spark, "orders-watermark", fresh=True)
    gate = gate_by_day(spark, _orders_by_month(spark, sf_dir), tpch_contract("orders"), root, "orders")
    store = WatermarkStore(spark, root)
    advance_from_gate(spark, store, "orders", gate)
    return store.current()


def watermark_report_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contracted entity with its watermark, or '(never loaded)'."""
    root = work_dir(spark, "orders-watermark-report", fresh=True)
    gate = gate_by_day(spark, _orders_by_month(spark, sf_dir), tpch_contract("orders"), root, "orders")
    store = WatermarkStore(spark, root)
    advance_from_gate(spark, store, "orders", gate)
    known = spark.createDataFrame([(e,) for e in available_contracts(TPCH_CONTRACTS)], "entity string")
    return watermark_report(known, store.current())


def incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only orders newer than the watermark (set to 2001-06-01)."""
    store = WatermarkStore(spark, work_dir(spark, "orders-incremental", fresh=True))
    store.set("orders", dt.date(2001, 6, 1))
    return store.incremental(table(spark, sf_dir, "orders"), "orders", "o_orderdate")


def load_log_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit log of one load per yearly batch: status and rows per load."""
    df = table(spark, sf_dir, "orders").withColumn("batch", F.date_format("o_orderdate", "yyyy"))
    verdicts = validate(df, tpch_contract("orders"), ["batch"]).verdicts
    log = LoadLog(spark, work_dir(spark, "orders-load-log", fresh=True))
    log.append(load_events(verdicts, "contractgate", "orders", "batch"))
    return log.status().select("load_id", "pipeline", "target_table", "status", "rows_loaded")


def _orders_csv_source(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Orders written as CSV files (a folder per year, files renamed into the
    source layout ``<src>/orders/orders_<year>_<n>.csv``). Returns (base, src)."""
    base = work_dir(spark, "orders-csv", fresh=True)
    tmp, src, raw = f"{base}/tmp", f"{base}/src", f"{base}/raw"
    o = table(spark, sf_dir, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus", F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
        F.date_format("o_orderdate", "yyyy").alias("year"),
    )
    text.write.partitionBy("year").option("header", "true").csv(tmp)
    # move each part file into <src>/orders/orders_<year>_<n>.csv
    tmp_path, fs = hadoop_fs(spark, tmp)
    jvm = spark._jvm
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{src}/orders"))
    for year_dir in fs.listStatus(tmp_path):
        name = year_dir.getPath().getName()
        if not name.startswith("year="):
            continue
        year = name.split("=", 1)[1]
        parts = sorted(str(s.getPath().getName()) for s in fs.listStatus(year_dir.getPath())
                       if s.getPath().getName().endswith(".csv"))
        for n, part in enumerate(parts):
            fs.rename(jvm.org.apache.hadoop.fs.Path(f"{tmp}/{name}/{part}"),
                      jvm.org.apache.hadoop.fs.Path(f"{src}/orders/orders_{year}_{n}.csv"))
    return base, src


def _csv_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV files ingested file by file: header per file, strict all-text
    scan, one validation job, routing by file. Returns the load manifest."""
    base, src = _orders_csv_source(spark, sf_dir)
    raw = f"{base}/raw"
    out = ingest(spark, src, raw, "2024-03-15", contracts_dir=TPCH_CONTRACTS, advance_watermark=False)
    return out.to_df(spark).withColumn("year", F.regexp_extract("source_file", r"orders_([0-9]{4})_", 1))


def csv_orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV ingest of orders, reported per year."""
    return _csv_manifest(spark, sf_dir).groupBy("year").agg(
        F.sum("rows").cast("bigint").alias("rows"),
        F.bool_and("accepted").alias("accepted"),
    )


def watermark_set_then_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advance per accepted month, rewind with ``set``, then advance with every
    accepted month again: the watermark is the latest of them."""
    root = work_dir(spark, "orders-watermark-rewind", fresh=True)
    gate = gate_by_day(spark, _orders_by_month(spark, sf_dir), tpch_contract("orders"), root, "orders")
    store = WatermarkStore(spark, root)
    advance_from_gate(spark, store, "orders", gate)
    store.set("orders", dt.date(1990, 1, 1))
    advance_from_gate(spark, store, "orders", gate)
    return store.current()


def stale_loads_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that started and never finished: one load per yearly batch is
    started; only the valid batches finish. The others are stale."""
    df = table(spark, sf_dir, "orders").withColumn("batch", F.date_format("o_orderdate", "yyyy"))
    verdicts = validate(df, tpch_contract("orders"), ["batch"]).verdicts
    events = load_events(verdicts, "contractgate", "orders", "batch")
    log = LoadLog(spark, work_dir(spark, "orders-stale", fresh=True))
    log.append(events.where((F.col("status") == "running") | (F.col("status") == "success")))
    cutoff = dt.datetime.now() + dt.timedelta(days=1)
    return stale_loads(log.status(), cutoff).select("load_id", "pipeline", "target_table", "status")


def csv_load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected rows of the CSV ingest of orders (AGG-5)."""
    return totals(_csv_manifest(spark, sf_dir)).select("accepted", "rows")


def staged_from_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage job: one load date (the latest accepted month) of the raw zone
    typed into the staged zone."""
    raw, gate = _landed_orders(spark, sf_dir)
    month = _latest_accepted_month(gate)
    staged_root = work_dir(spark, "orders-staged", fresh=True)
    df = None
    if month is not None:
        stage(spark, raw, staged_root, month, ["orders"], TPCH_CONTRACTS)
        df = read_staged(spark, staged_root, "orders", month)
    if df is None:  # every month was rejected: nothing in raw, nothing staged
        typed = apply_contract_types(table(spark, sf_dir, "orders"), tpch_contract("orders"))
        df = _empty_like(spark, typed, "source_file string, year string, month string, day string")
    return df


def stream_landed_orders_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming landing over the CSV files of orders (available-now
    trigger): per year of the source files, whether every file was accepted and
    how many rows were landed in raw."""
    from ..streaming.landing import stream_ingest

    base, src = _orders_csv_source(spark, sf_dir)
    raw = f"{base}/raw"
    outcomes: list = []
    q = stream_ingest(spark, src, "orders", raw, f"{base}/checkpoint", contracts_dir=TPCH_CONTRACTS,
                      load_date=dt.date(2024, 3, 15), advance_watermark=False, outcomes=outcomes)
    q.awaitTermination()
    year = F.regexp_extract("source_file", r"orders_([0-9]{4})_", 1)
    verdicts = spark.createDataFrame(
        [(m["source_file"], m["accepted"]) for o in outcomes for m in o.manifest],
        "source_file string, accepted boolean",
    ).groupBy(year.alias("year")).agg(F.bool_and("accepted").alias("accepted"))
    landed = read_raw(spark, raw, "orders")
    if landed is None:
        landed = spark.createDataFrame([], "source_file string")
    counts = landed.groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("landed_rows"))
    return (verdicts.join(counts, on="year", how="left")
            .select("year", "accepted", F.coalesce("landed_rows", F.lit(0)).cast("bigint").alias("landed_rows")))


def raw_calendar_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with data columns named like the zone's partition columns (year,
    day, source_file): landed by month and read back, values as received."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "E").alias("day"),
        F.concat(F.lit("file-"), F.col("o_custkey").cast("string")).alias("source_file"), "o_orderdate")
    contract = Contract.from_dict({"entity": "calendar_orders", "version": "1.0.0", "primary_key": ["o_orderkey"], "columns": [
        {"name": "o_orderkey", "type": "integer", "nullable": False}, {"name": "year", "type": "integer"},
        {"name": "day"}, {"name": "source_file"}, {"name": "o_orderdate", "type": "timestamp"}]})
    root = work_dir(spark, "orders-calendar", fresh=True)
    gate_by_day(spark, with_batches(o, F.trunc("o_orderdate", "month"), F.lit("orders.parquet")), contract, root, "calendar_orders")
    return read_raw(spark, root, "calendar_orders")


LOOSE_CONTRACTS = PACKAGE_CONTRACTS / "loose"  # orders without domain rules
_MIXED_DAY = dt.date(2024, 3, 15)


def _copied(spark: SparkSession, df: DataFrame, fmt: str, folder: str, name: str) -> None:
    """Write ``df`` as one source file ``<folder>/<name>``."""
    tmp = f"{folder}-tmp-{name}"
    writer = df.coalesce(1).write.option("header", "true")
    writer.format(fmt).save(tmp)
    p, fs = hadoop_fs(spark, tmp)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(folder))
    part = next(s.getPath() for s in fs.listStatus(p) if str(s.getPath().getName()).startswith("part-"))
    if not fs.rename(part, path(folder, name)):
        raise OSError(f"cannot name {name}")
    fs.delete(p, True)


def _copied_at_once(spark: SparkSession, folder: str, files: list[tuple[DataFrame, str, str]]) -> None:
    """``_copied`` for (rows, format, name) of several files: each is one task's work, so they are written side by side."""
    with ThreadPoolExecutor(len(files)) as pool:
        list(pool.map(lambda f: _copied(spark, f[0], f[1], folder, f[2]), files))


def _plain_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def staged_mixed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day that arrived as a CSV file, a Parquet file, and a Parquet file with
    narrower integers: each is typed in its own way, the staged day has them all."""
    base = work_dir(spark, "orders-mixed", fresh=True)
    o, src = _plain_orders(spark, sf_dir), f"{base}/src/orders"
    _copied_at_once(spark, src, [
        (o.where("o_orderkey % 3 = 0").select(*[F.col(c).cast("string") for c in o.columns]), "csv", "a.csv"),
        (o.where("o_orderkey % 3 = 1"), "parquet", "b.parquet"),
        (o.where("o_orderkey % 3 = 2").withColumn("o_custkey", F.col("o_custkey").cast("int")), "parquet", "c.parquet")])
    ingest(spark, f"{base}/src", f"{base}/raw", _MIXED_DAY, contracts_dir=LOOSE_CONTRACTS, advance_watermark=False)
    stage(spark, f"{base}/raw", f"{base}/staged", _MIXED_DAY, ["orders"], LOOSE_CONTRACTS)
    return read_staged(spark, f"{base}/staged", "orders", _MIXED_DAY)


def dead_letter_mixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rejected files with an unexpected column each: the dead-letter zone
    reads back every received value of both."""
    base = work_dir(spark, "orders-dead-mixed", fresh=True)
    o, src = _plain_orders(spark, sf_dir), f"{base}/src/orders"
    o = o.select(*[F.col(c).cast("string") for c in o.columns])
    _copied_at_once(spark, src, [
        (o.where("o_orderkey % 2 = 0").withColumn("clerk", F.concat(F.lit("c"), "o_custkey")), "csv", "a.csv"),
        (o.where("o_orderkey % 2 = 1").withColumn("depot", F.concat(F.lit("d"), "o_custkey")), "csv", "b.csv")])
    ingest(spark, f"{base}/src", f"{base}/raw", _MIXED_DAY, contracts_dir=LOOSE_CONTRACTS, advance_watermark=False)
    df = read_raw(spark, f"{base}/raw", "orders", _MIXED_DAY, dead_letter=True)
    return df.select("o_orderkey", "clerk", "depot", "source_file")


def restage_zero_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged day whose file is landed again without rows: the second staging
    replaces the rows. Returns rows staged before and after, per source file."""
    base = work_dir(spark, "orders-restage", fresh=True)
    o, src = _plain_orders(spark, sf_dir), f"{base}/src/orders"
    text = o.select(*[F.col(c).cast("string") for c in o.columns])
    out = []
    for step, rows in (("first", text), ("again", text.where("false"))):
        p, fs = hadoop_fs(spark, f"{src}/a.csv")
        fs.delete(p, False)
        _copied(spark, rows, "csv", src, "a.csv")
        ingest(spark, f"{base}/src", f"{base}/raw", _MIXED_DAY, contracts_dir=LOOSE_CONTRACTS, advance_watermark=False)
        reported = stage(spark, f"{base}/raw", f"{base}/staged", _MIXED_DAY, ["orders"], LOOSE_CONTRACTS)
        staged = read_staged(spark, f"{base}/staged", "orders", _MIXED_DAY)
        out.append((step, sum(r["rows"] for r in reported), len(reported), staged.count()))
    return spark.createDataFrame(out, "step string, reported_rows bigint, files int, staged_rows bigint")


# File name -> lines before the rows; rows have the contract's columns in order.
_NAMES = "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority"
_AWKWARD = {
    "my file.csv": [_NAMES], "f[1].csv": [_NAMES], "100%.csv": [_NAMES], "_hidden.csv": [_NAMES], ".dot.csv": [_NAMES],
    "blank line.csv": ["", _NAMES],
    "case.csv": [_NAMES.replace("o_custkey", "O_ORDERKEY")],  # two names that differ only in case
    "quoted.csv": ['"o_order', 'key",' + _NAMES.split(",", 1)[1]],  # a line end inside a name
}


def csv_awkward_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders over files whose names or headers are awkward: one verdict each."""
    base = work_dir(spark, "orders-awkward", fresh=True)
    o = _plain_orders(spark, sf_dir)
    for k, (name, header) in enumerate(_AWKWARD.items()):
        rows = o.where(F.col("o_orderkey") % len(_AWKWARD) == k).select(F.concat_ws(",", *o.columns).alias("value"))
        lines = spark.createDataFrame([(line,) for line in header], "value string").coalesce(1).unionByName(rows)
        _copied(spark, lines, "text", f"{base}/src/orders", name)
    out = ingest(spark, f"{base}/src", f"{base}/raw", _MIXED_DAY, contracts_dir=LOOSE_CONTRACTS, advance_watermark=False)
    return out.to_df(spark).select("source_file", "accepted", "rows")


def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events dated after a watermark's day, by times of day; every hundredth has
    no date and is kept."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_id") % 100 != 0, F.col("ts")))
    middle = e.agg(F.to_date(F.expr("timestamp_micros(cast(avg(unix_micros(cast(ts as timestamp))) as bigint))")).alias("d")).first().d
    store = WatermarkStore(spark, work_dir(spark, "events-incremental", fresh=True))
    store.set("events", middle)
    return store.incremental(e, "events", "ts").select("event_id", "ts")


def numeric_dates_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as numbers (nanoseconds since the epoch) and as text with
    digits that are no date: what the date rule counts and what staging keeps."""
    day = F.unix_date(F.to_date("o_orderdate")).cast("bigint")
    text = F.element_at(F.array(*map(F.lit, ("12345", "202001", "T12:30:00Z", "99999-01-01", "2020-01-15"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", (day * 86_400_000_000_000).alias("as_number"), text.alias("as_text"), "o_orderdate")
    contract = Contract.from_dict({"entity": "numeric_dates", "version": "1.0.0", "columns": [
        {"name": "o_orderkey", "type": "integer"}, {"name": "as_number", "type": "date"}, {"name": "as_text", "type": "date"}]})
    failing = validate(o.drop("o_orderdate"), contract).violations.select(F.col("column").alias("what"), F.col("failing_rows").alias("rows"))
    typed = apply_contract_types(o, contract)
    staged = typed.groupBy().agg(F.count_if(F.col("as_number") == F.to_date("o_orderdate")).alias("numbers right"), F.count("as_text").alias("texts staged"))
    return failing.unionByName(staged.unpivot([], ["numbers right", "texts staged"], "what", "rows"))


def _parquet_day(spark: SparkSession, sf_dir: str, base: str) -> str:
    """Orders as one Parquet file per status, and an entity without a contract."""
    o, src = _plain_orders(spark, sf_dir), f"{base}/src"
    _copied_at_once(spark, f"{src}/orders", [
        (o.where(F.col("o_orderstatus") == status), "parquet", f"{status}.parquet") for status in ("F", "O", "P")])
    _copied(spark, table(spark, sf_dir, "region"), "parquet", f"{src}/no_contract", "region.parquet")
    _copied(spark, table(spark, sf_dir, "nation"), "parquet", f"{src}/not_asked_for", "nation.parquet")
    return src


def ingest_parquet_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet sources of a day, for some entities only: one summary line per
    file; an entity without a contract is passed over."""
    base = work_dir(spark, "orders-parquet", fresh=True)
    out = ingest(spark, _parquet_day(spark, sf_dir, base), f"{base}/raw", _MIXED_DAY, ["orders", "no_contract"], LOOSE_CONTRACTS, False)
    return summary(out.to_df(spark)).withColumn("skipped", F.lit(",".join(out.skipped_entities)))


def staged_totals_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage manifest of that day, added up per entity and in all."""
    base = work_dir(spark, "orders-staged-totals", fresh=True)
    ingest(spark, _parquet_day(spark, sf_dir, base), f"{base}/raw", _MIXED_DAY, ["orders"], LOOSE_CONTRACTS, False)
    return staged_total(stage_manifest(spark, stage(spark, f"{base}/raw", f"{base}/staged", _MIXED_DAY, ["orders"], LOOSE_CONTRACTS)))


def staged_boolean_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as boolean text in several spellings, typed."""
    spelling = F.array(*map(F.lit, ("true", "FALSE", "1", "0", "yes", "True")))
    text = F.element_at(spelling, ((F.col("doc_id") + F.col("quality")) % 6 + 1).cast("int"))
    contract = Contract.from_dict({"entity": "labels", "version": "1.0.0", "columns": [
        {"name": "doc_id", "type": "integer"}, {"name": "quality", "type": "boolean"}]})
    return apply_contract_types(table(spark, sf_dir, "labels").select("doc_id", text.alias("quality")), contract)


def run_load_log_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two audited runs over orders as CSV, as many files as Spark has tasks: all
    files good, then the odd orders' with an unexpected column. The load log says how they ended."""
    base = work_dir(spark, "orders-runs", fresh=True)
    o = _plain_orders(spark, sf_dir)
    o = o.select(*[F.col(c).cast("string") for c in o.columns])
    log = LoadLog(spark, f"{base}/raw")
    for day in (dt.date(2024, 3, 15), dt.date(2024, 3, 16)):
        _files_of(spark, o.where("o_orderkey % 2 = 0"), f"{base}/src-{day}/orders", "even")
        odd = o.where("o_orderkey % 2 = 1")
        _files_of(spark, odd if day.day == 15 else odd.withColumn("clerk", F.lit("x")), f"{base}/src-{day}/orders", "odd")
        try:
            run_load(spark, f"{base}/src-{day}", f"{base}/raw", f"{base}/staged", day, ["orders"], LOOSE_CONTRACTS, pipeline=f"day-{day}")
        except RuntimeError:  # how a run with quarantined files ends
            pass
    return log.status().select("pipeline", "target_table", "status", "rows_loaded")


def stale_loads_by_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per order month, started on its first day; loads of even months
    ended. Stale: those still running that started before the middle of 1998."""
    month = F.trunc("o_orderdate", "month")
    months = table(spark, sf_dir, "orders").groupBy(month.alias("m")).agg(F.count(F.lit(1)).alias("n"))
    load_id = F.date_format("m", "yyyy-MM")
    start = months.select(load_id.alias("load_id"), F.lit("monthly").alias("pipeline"), F.lit("orders").alias("target_table"),
                          F.lit("running").alias("status"), F.lit(None).cast("bigint").alias("rows_loaded"), F.col("m").cast("timestamp_ntz").alias("event_at"))
    end = months.where(F.month("m") % 2 == 0).select(
        load_id.alias("load_id"), F.lit(None).cast("string").alias("pipeline"), F.lit(None).cast("string").alias("target_table"),
        F.lit("success").alias("status"), F.col("n").alias("rows_loaded"), F.date_add("m", 1).cast("timestamp_ntz").alias("event_at"))
    log = LoadLog(spark, work_dir(spark, "orders-stale-cutoff", fresh=True))
    log.append(start.unionByName(end))
    return stale_loads(log.status(), dt.datetime(1998, 7, 1)).select("load_id", "pipeline", "target_table", "status")


def _files_of(spark: SparkSession, df: DataFrame, folder: str, name: str) -> None:
    """Write ``df`` (all text) as CSV files ``<folder>/<name>_<n>.csv``, as many as Spark has tasks."""
    df.write.option("header", "true").csv(f"{folder}-{name}")
    p, fs = hadoop_fs(spark, f"{folder}-{name}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(folder))
    parts = sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if str(s.getPath().getName()).endswith(".csv"))
    for n, part in enumerate(parts):
        target = path(folder, f"{name}_{n}.csv")
        fs.delete(target, False)
        if not fs.rename(path(p, part), target):
            raise OSError(f"cannot name {target.toString()}")
    fs.delete(p, True)


def replayed_files_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that were quarantined for a column too many arrive again, mended: they land in
    raw at their keys, and what was quarantined stays. Rows per zone and kind of file."""
    base = work_dir(spark, "orders-replay", fresh=True)
    o, src = _plain_orders(spark, sf_dir), f"{base}/src/orders"
    o = o.select(*[F.col(c).cast("string") for c in o.columns])
    odd = o.where("o_orderkey % 2 = 1")
    _files_of(spark, o.where("o_orderkey % 2 = 0"), src, "even")
    for sent in (odd.withColumn("clerk", F.lit("x")), odd):
        _files_of(spark, sent, src, "odd")
        ingest(spark, f"{base}/src", f"{base}/raw", _MIXED_DAY, contracts_dir=LOOSE_CONTRACTS, advance_watermark=False)
    kind = F.regexp_extract("source_file", "^([a-z]+)_", 1).alias("kind")
    zones = [read_raw(spark, f"{base}/raw", "orders", _MIXED_DAY, dead_letter=dead).groupBy(F.lit(zone).alias("zone"), kind).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("orders")) for zone, dead in (("raw", False), ("quarantine", True))]
    return zones[0].unionByName(zones[1])


def empty_day_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days are staged, of which only the first has files: rows and files reported and staged for each."""
    base = work_dir(spark, "orders-empty-day", fresh=True)
    o = _plain_orders(spark, sf_dir)
    _files_of(spark, o.select(*[F.col(c).cast("string") for c in o.columns]), f"{base}/src/orders", "all")
    ingest(spark, f"{base}/src", f"{base}/raw", _MIXED_DAY, contracts_dir=LOOSE_CONTRACTS, advance_watermark=False)
    out = None
    for day in (_MIXED_DAY, _MIXED_DAY + dt.timedelta(days=1)):
        reported = stage(spark, f"{base}/raw", f"{base}/staged", day, ["orders"], LOOSE_CONTRACTS)
        staged = read_staged(spark, f"{base}/staged", "orders", day)
        staged = staged.select("o_orderkey") if staged is not None else spark.createDataFrame([], "o_orderkey bigint")
        row = staged.agg(F.count(F.lit(1)).alias("staged_rows"), F.count_distinct("o_orderkey").alias("orders")).select(
            F.lit(day).alias("day"), F.lit(bool(reported)).alias("found"), F.lit(sum(r["rows"] for r in reported)).cast("bigint").alias("reported_rows"), "staged_rows", "orders")
        out = row if out is None else out.unionByName(row)
    return out


def manifest_order_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load manifest lists files in name order: the place of each kind of file in it, with its rows."""
    base = work_dir(spark, "orders-manifest-order", fresh=True)
    o = _plain_orders(spark, sf_dir)
    text = o.select(*[F.col(c).cast("string") for c in o.columns])
    for name in ("b", "B", "a10", "a9"):
        _files_of(spark, text.where(F.col("o_orderkey").cast("bigint") % 4 == ("b", "B", "a10", "a9").index(name)), f"{base}/src/orders", name)
    out = ingest(spark, f"{base}/src", f"{base}/raw", _MIXED_DAY, contracts_dir=LOOSE_CONTRACTS, advance_watermark=False)
    kinds = []
    for m in out.manifest:  # one entry a file, as reported
        kind = m["source_file"].rpartition("_")[0]
        if not kinds or kinds[-1][1] != kind:
            kinds.append([len(kinds), kind, 0])
        kinds[-1][2] += m["rows"]
    return spark.createDataFrame([tuple(k) for k in kinds], "position int, kind string, rows bigint")


def csv_extra_fields_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files by order month in which every 50th order has a field more than the header: per month, whether
    its file was accepted, and the rows with a field too many that the manifest counts."""
    base = work_dir(spark, "orders-extra-fields", fresh=True)
    o = _plain_orders(spark, sf_dir)
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in o.columns], F.when(F.col("o_orderkey") % 50 == 0, F.lit("more")))
    month = F.substring("o_orderdate", 1, 7).alias("month")
    rows = o.select(month, F.lit(1).alias("nth"), line.alias("value"))
    heads = o.select(month).distinct().select("month", F.lit(0).alias("nth"), F.lit(",".join(o.columns)).alias("value"))
    ordered = heads.unionByName(rows).repartition("month").sortWithinPartitions("month", "nth").select("month", "value")
    ordered.write.partitionBy("month").text(f"{base}/parts")
    p, fs = hadoop_fs(spark, f"{base}/parts")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(f"{base}/src/orders"))
    for folder in fs.listStatus(p):
        name = str(folder.getPath().getName())
        if name.startswith("month="):
            part = next(s.getPath() for s in fs.listStatus(folder.getPath()) if str(s.getPath().getName()).startswith("part-"))
            fs.rename(part, path(f"{base}/src/orders", name.removeprefix("month=") + ".csv"))
    out = ingest(spark, f"{base}/src", f"{base}/raw", _MIXED_DAY, contracts_dir=LOOSE_CONTRACTS, advance_watermark=False)
    report = F.from_json("manifest_json", "violations array<struct<check string, message string, failing_rows bigint>>")["violations"]
    extra = F.aggregate(F.filter(report, lambda v: v["check"] == "schema"), F.lit(0).cast("bigint"), lambda a, v: a + v["failing_rows"])
    return out.to_df(spark).select(F.replace("source_file", F.lit(".csv"), F.lit("")).alias("month"), "accepted", "rows", extra.alias("extra_rows"))


REGISTERED = [
    "replayed_files_orders",
    "empty_day_orders",
    "manifest_order_orders",
    "csv_extra_fields_orders",
    "ingest_parquet_summary",
    "staged_totals_orders",
    "staged_boolean_labels",
    "run_load_log_orders",
    "stale_loads_by_cutoff",
    "raw_calendar_columns",
    "staged_mixed_formats",
    "dead_letter_mixed_columns",
    "restage_zero_rows",
    "csv_awkward_files",
    "incremental_events",
    "numeric_dates_orders",
    "staged_orders",
    "coercions_orders",
    "raw_orders_month",
    "relanded_orders",
    "reconciled_orders",
    "dead_letter_orders",
    "dead_letter_manifests_orders",
    "watermark_orders",
    "watermark_report_tpch",
    "incremental_orders",
    "load_log_orders",
    "csv_orders_by_year",
    "watermark_set_then_advance",
    "stale_loads_orders",
    "csv_load_totals",
    "staged_from_raw_orders",
    "stream_landed_orders_csv",
]
