"""Benchmark of the headline jobs; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3; the median is
reported). Scratch zones go under the session's checkpoint folder.

  violations_lineitem      full violation report of lineitem (rules + keys), one pass
  violations_by_year       same, one batch per ship year
  violations_sf001         same report at sf 0.01 (for the scaling ratio)
  staged_orders_write      orders as text -> typed projection -> staged write of one day
  land_orders_by_day       gate orders with one batch per day into raw (dynamic overwrite)
  reland_orders_by_day     the same load again over the existing zone (replaces, never duplicates)
  csv_validate_multiline   strict CSV scan of orders (one file per year) + validation, multiLine on
  csv_validate_singleline  the same with multiLine off (splittable)
  csv_validate_auto        the same with the quoted-newline pre-scan choosing the reader per file
  ingest_orders_csv_files  the ingest job over those files: headers, pre-scan, validation, landing,
                           dead letters and manifests (re-runs overwrite)
  stage_orders_day         the stage job: that day of raw typed into the staged zone
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from contractgate.operators.contract import PACKAGE_CONTRACTS  # noqa: E402
from contractgate.operators.project import apply_contract_types  # noqa: E402
from contractgate.operators.validate import validate  # noqa: E402
from contractgate.plans.batches import gate_by_day, with_batches  # noqa: E402
from contractgate.plans.tables import table, tpch_contract  # noqa: E402
from contractgate.session import local_session, work_dir  # noqa: E402
from contractgate.sinks.zones import write_staged  # noqa: E402
from contractgate.sources.files import csv_header  # noqa: E402
from contractgate.sources.scans import EXTRA, SOURCE_FILE, read_csv_auto  # noqa: E402


def timed(fn, runs):
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return statistics.median(times)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="contractgate-bench")
    sf = sf_dir.rsplit("sf", 1)[-1]
    small_dir = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    q: dict[str, float] = {}
    rows: dict[str, int] = {}

    lineitem = tpch_contract("lineitem")
    orders_c = tpch_contract("orders")
    rows["lineitem"] = table(spark, sf_dir, "lineitem").count()
    rows["orders"] = table(spark, sf_dir, "orders").count()

    def report(d, by_year=False):
        df = table(spark, d, "lineitem")
        if by_year:
            df = df.withColumn("batch", F.date_format("l_shipdate", "yyyy"))
        return validate(df, lineitem, ["batch"] if by_year else None).violations.collect()

    q["violations_lineitem"] = timed(lambda: report(sf_dir), runs)
    q["violations_by_year"] = timed(lambda: report(sf_dir, True), runs)
    if os.path.isdir(small_dir) and small_dir != sf_dir:
        q["violations_sf001"] = timed(lambda: report(small_dir), runs)

    staged_root = work_dir(spark, "bench-staged", fresh=True)

    def staged():
        o = table(spark, sf_dir, "orders")
        text = o.select(*[F.col(c).cast("string").alias(c) for c in o.columns])
        typed = apply_contract_types(text, orders_c)
        write_staged(typed, staged_root, "orders", "2024-03-15")

    q["staged_orders_write"] = timed(staged, runs)

    raw_root = work_dir(spark, "bench-raw", fresh=True)

    def land():
        df = with_batches(table(spark, sf_dir, "orders"), F.col("o_orderdate"))
        gate_by_day(spark, df, orders_c, raw_root, "orders")

    t = time.perf_counter()
    land()
    q["land_orders_by_day"] = time.perf_counter() - t
    q["reland_orders_by_day"] = timed(land, max(1, runs - 1))

    # CSV source: orders as one CSV folder per year, read with per-file headers
    csv_root = work_dir(spark, "bench-csv", fresh=True)
    o = table(spark, sf_dir, "orders")
    (o.select(*[F.col(c).cast("string").alias(c) for c in o.columns if c != "o_orderdate"],
              F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
              F.date_format("o_orderdate", "yyyy").alias("year"))
     .write.partitionBy("year").option("header", "true").csv(f"{csv_root}/orders"))
    csv_paths = sorted(
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv").load(csv_root).inputFiles())
    names = csv_header(spark, csv_paths[0])  # every part file was written with the same header

    def csv_validate(multi_line):
        df = read_csv_auto(spark, csv_paths, names, multi_line=multi_line)
        v = validate(df, orders_c, [SOURCE_FILE], extra_column=EXTRA, actual=names)
        return v.manifest().collect()

    q["csv_validate_multiline"] = timed(lambda: csv_validate(True), runs)
    q["csv_validate_singleline"] = timed(lambda: csv_validate(False), runs)
    q["csv_validate_auto"] = timed(lambda: csv_validate("auto"), runs)

    # the ingest job end to end over the same CSV files laid out as <src>/orders/<file>.csv
    from contractgate.plans.ingest import ingest, stage
    from contractgate.plans.tables import TPCH_CONTRACTS
    from contractgate.sources.files import hadoop_fs
    src = f"{csv_root}/src"
    jvm = spark._jvm
    _, fs = hadoop_fs(spark, src)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{src}/orders"))
    for i, path in enumerate(csv_paths):
        fs.rename(jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{src}/orders/orders_{i:03d}.csv"))
    ingest_raw = work_dir(spark, "bench-ingest-raw", fresh=True)
    ingest_staged = work_dir(spark, "bench-ingest-staged", fresh=True)
    q["ingest_orders_csv_files"] = timed(
        lambda: ingest(spark, src, ingest_raw, "2024-03-15", contracts_dir=TPCH_CONTRACTS, advance_watermark=False),
        runs)
    # staging needs accepted files: land them once more under the contract without a price limit (untimed)
    loose = PACKAGE_CONTRACTS / "loose"
    ok_raw = work_dir(spark, "bench-ingest-raw-ok", fresh=True)
    landed = ingest(spark, src, ok_raw, "2024-03-15", contracts_dir=loose, advance_watermark=False)
    rows["staged_orders_day"] = sum(m["rows"] for m in landed.accepted)
    q["stage_orders_day"] = timed(lambda: stage(spark, ok_raw, ingest_staged, "2024-03-15", ["orders"], loose), runs)

    total = sum(q.values())
    out = {
        "metric": "total_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": sf,
        "rows": rows,
        "rows_per_sec": {
            "violations_lineitem": round(rows["lineitem"] / q["violations_lineitem"]),
            "staged_orders_write": round(rows["orders"] / q["staged_orders_write"]),
            "land_orders_by_day": round(rows["orders"] / q["land_orders_by_day"]),
            "ingest_orders_csv_files": round(rows["orders"] / q["ingest_orders_csv_files"]),
        },
        "scaling_sf01_over_sf001": round(q["violations_lineitem"] / q["violations_sf001"], 2)
        if "violations_sf001" in q else None,
        "spark": spark.version,
        "local_cpus": cpus,
        "runs": runs,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
