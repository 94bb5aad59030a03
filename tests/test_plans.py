"""Physical-plan properties the design relies on at scale (read from explain)."""
import datetime as dt

from pyspark.sql import functions as F

from contractgate.operators.route import route
from contractgate.operators.state import newer_than
from contractgate.operators.validate import validate
from contractgate.plans.tables import table, tpch_contract

SF = "/root/testdata/sf0.001"


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_report_is_aggregates_without_joins(spark, capsys):
    df = table(spark, SF, "lineitem")
    text = plan(validate(df, tpch_contract("lineitem")).violations, capsys)
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "Join" not in text
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    # one scan for the rule counters, one that reads only the key columns
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in schemas
    assert text.count("HashAggregate") >= 4  # partial + final for both aggregates


def test_batched_report_shuffles_only_batch_keys(spark, capsys):
    df = table(spark, SF, "orders").withColumn("batch", F.date_format("o_orderdate", "yyyy"))
    text = plan(validate(df, tpch_contract("orders"), ["batch"]).verdicts, capsys)
    assert "Join" not in text
    exchanges = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning(")]
    # rule counters and the re-aggregate shuffle by batch; the key count by (batch, key)
    assert exchanges and all(line.startswith("Arguments: hashpartitioning(batch#") for line in exchanges)
    assert any("o_orderkey" in line for line in exchanges)


def test_route_never_shuffles_the_data(spark, capsys):
    df = table(spark, SF, "orders").withColumn("batch", F.date_format("o_orderdate", "yyyy"))
    v = validate(df, tpch_contract("orders"), ["batch"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")  # statistics as of a very large table
    try:
        for side, kind in zip(route(df, v.verdicts, ["batch"]), ("LeftSemi", "LeftAnti")):
            text = plan(side, capsys)
            assert "BroadcastHashJoin" in text and kind in text
            assert "Exchange hashpartitioning" not in text and "hashpartitioning" not in text and "NestedLoop" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_large_verdict_table_is_not_broadcast(spark, capsys, monkeypatch):
    import contractgate.operators.route as r
    monkeypatch.setattr(r, "MAX_BROADCAST_BYTES", 0)
    keys = table(spark, SF, "orders").select("o_orderkey")
    assert r.maybe_broadcast(keys, 0) is keys and r.maybe_broadcast(keys) is not keys


def test_incremental_filter_reaches_the_scan(spark, capsys):
    df = newer_than(table(spark, SF, "orders"), dt.date(2001, 6, 1), "o_orderdate")
    text = plan(df, capsys)
    assert "PushedFilters: [Or(IsNull(o_orderdate),GreaterThanOrEqual(o_orderdate," in text


def test_raw_day_scan_lists_only_that_day(spark, good_customers, tmp_path):
    from contractgate.plans.ingest import ingest
    from contractgate.sources.scans import read_raw
    src = tmp_path / "src" / "customers"
    src.mkdir(parents=True)
    good_customers.to_csv(src / "customers.csv", index=False)
    raw = str(tmp_path / "raw")
    for day in ("2024-03-15", "2024-03-16"):
        ingest(spark, str(tmp_path / "src"), raw, day, advance_watermark=False)
    df = read_raw(spark, raw, "customers", "2024-03-16")
    assert df.count() == 2
    assert all("/year=2024/month=03/day=16/" in f for f in df.inputFiles())
    assert {r["day"] for r in df.select("day").distinct().collect()} == {"16"}


def test_file_batch_landing_has_no_shuffle(spark, tmp_path, capsys):
    from pyspark.sql import functions as F
    from contractgate.sinks.zones import EXTRA, SOURCE_FILE, date_part_columns
    from contractgate.sources.scans import read_csv_strict
    p = tmp_path / "f.csv"
    p.write_text("a,b\n1,2\n3,4\n")
    df = read_csv_strict(spark, [str(p)], ["a", "b"], multi_line=False).drop(EXTRA)
    out = df.withColumns({**date_part_columns("2024-03-15"), "source_file": F.col(SOURCE_FILE)})
    text = plan(out, capsys)
    assert "Exchange" not in text
