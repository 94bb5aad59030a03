"""Registered zone queries over tables of their own: what they return where a zone stays empty."""
import datetime as dt

import pytest

from contractgate.plans import zone_checks

DATA = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
        ("o_orderdate", "timestamp"), ("o_orderpriority", "string")]
PARTS = [("year", "string"), ("month", "string"), ("day", "string"), ("source_file", "string")]


def orders(spark, folder, prices):
    rows = [(i, i + 7, "FOP"[i % 3], price, dt.datetime(1995 + i % 2, 3, 1 + i), "1-URGENT") for i, price in enumerate(prices)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in DATA))
    df.coalesce(1).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["raw_orders_month", "relanded_orders", "staged_from_raw_orders"])
def test_no_month_is_accepted(spark, tmp_path, name):
    sf = orders(spark, tmp_path, [499_500.0] * 4)  # above the contract's limit
    found = getattr(zone_checks, name)(spark, sf)
    assert found.count() == 0
    if name == "staged_from_raw_orders":
        data = [(n, "date" if n == "o_orderdate" else t) for n, t in DATA]
        assert found.dtypes == [*data, PARTS[3], *PARTS[:3]]
    else:
        assert found.dtypes == [*DATA, *PARTS]


def test_no_month_is_rejected(spark, tmp_path):
    sf = orders(spark, tmp_path, [10.0] * 4)
    dead, manifests = zone_checks.dead_letter_orders(spark, sf), zone_checks.dead_letter_manifests_orders(spark, sf)
    assert dead.count() == 0 and dead.dtypes == [*DATA, *PARTS]
    assert manifests.count() == 0 and manifests.columns[:6] == ["contract_version", "entity", "is_valid", "manifest_json", "n_violations", "row_count"]


def test_duplicate_keys_are_counted_by_as_many_tasks_as_rows_ask_for(spark, capsys, monkeypatch):
    import contractgate.operators.validate as v
    from contractgate.operators.contract import Contract
    contract = Contract.from_dict({"entity": "e", "version": "1", "primary_key": ["k"], "columns": [{"name": "k", "type": "integer"}]})
    rows = [("a", k) for k in (1, 2, 2, None, None, None, 4)] + [("b", k) for k in (1, 2, 3, 3, 3)]
    df = spark.createDataFrame(rows, "batch string, k bigint")

    def found():
        table = v.validate(df, contract, ["batch"]).violations.where("check = 'uniqueness'")
        table.explain("formatted")
        return sorted((r.batch, r.failing_rows) for r in table.collect()), "REPARTITION_BY_NUM" in capsys.readouterr().out

    assert found() == ([("a", 3), ("b", 2)], False)
    monkeypatch.setattr(v, "KEYS_PER_TASK", 3)
    assert found() == ([("a", 3), ("b", 2)], True)


def test_a_task_holds_files_open_instead_of_sorting(spark, tmp_path):
    from pyspark.sql import functions as F

    from contractgate.sinks.zones import OPEN_FILES, write_partitioned
    from contractgate.sources.scans import read_partitioned
    held = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    path = str(tmp_path / "zone")
    df = spark.range(100).select("id", (F.col("id") % (2 * OPEN_FILES)).cast("string").alias("part")).coalesce(1)
    write_partitioned(df, path, ["part"], open_files=OPEN_FILES)  # more partitions than files held open
    back = read_partitioned(spark, path, partition_columns=["part"])
    assert sorted(map(tuple, back.select("id", "part").collect())) == [(i, str(i % (2 * OPEN_FILES))) for i in range(100)]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == held


def test_rows_are_dealt_to_as_many_write_tasks_as_they_ask_for(spark):
    from contractgate.plans.batches import FILES, ROWS_PER_TASK, dealt
    df = spark.range(10).selectExpr("id", "id % 3 AS k", f"1L AS {FILES}")
    assert dealt(df, ["k"], 3, 5 * ROWS_PER_TASK).rdd.getNumPartitions() == 5
    assert dealt(df, ["k"], 3, 10).rdd.getNumPartitions() == 1


def test_single_files_are_written_side_by_side(monkeypatch):
    import threading
    meet = threading.Barrier(3, timeout=30)
    monkeypatch.setattr(zone_checks, "_copied", lambda *args: meet.wait())
    zone_checks._copied_at_once(None, "folder", [(None, "csv", n) for n in "abc"])


def test_audited_runs_read_files_of_many_tasks(spark, tmp_path, monkeypatch):
    from contractgate.sources.files import list_source_files
    sf, seen, run = orders(spark, tmp_path, [10.0] * 12), [], zone_checks.run_load
    df = spark.read.parquet(f"{sf}/orders.parquet").repartition(3)
    df.write.parquet(f"{tmp_path}/several/orders.parquet")
    monkeypatch.setattr(zone_checks, "run_load", lambda s, src, *a, **k: (seen.append(len(list_source_files(s, src))), run(s, src, *a, **k)))
    got = zone_checks.run_load_log_orders(spark, f"{tmp_path}/several").collect()
    assert sorted((r.pipeline, r.status, r.rows_loaded) for r in got) == [("day-2024-03-15", "success", 12), ("day-2024-03-16", "failed", 6)]
    assert len(seen) == 2 and min(seen) > 2


def test_text_is_trimmed_of_white_space(spark):
    from contractgate.functions import coerce
    from pyspark.sql import types as T
    texts = ["\t 1\n", "\x0b2\f\r", "3 ", " 4 5 ", "", " ", " 6"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert "regexp_replace" not in coerce.to_number("x", T.StringType())
    assert [r[0] for r in df.selectExpr(coerce.to_number("x", T.StringType())).collect()] == [1.0, 2.0, 3.0, None, None, None, None]
