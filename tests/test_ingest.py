"""Landing, dead-lettering, idempotency, staging and the jobs, on temp folders."""
import datetime as dt
import json
import os

import pytest

from contractgate.plans.ingest import ingest, run_load, stage, summary, totals, watermark_report
from contractgate.operators.project import apply_contract_types
from contractgate.operators.contract import load_contract
from contractgate.operators.state import WatermarkStore
from contractgate.sinks.zones import partitioned_key
from contractgate.sources.scans import read_raw, read_staged

D = dt.date(2024, 3, 15)


def files_under(root):
    out = []
    for dirpath, _, names in os.walk(root):
        for n in names:
            if n.endswith((".parquet", ".json")) and not n.startswith((".", "_")):
                out.append(os.path.relpath(os.path.join(dirpath, n), root))
    return sorted(out)


def write_source(tmp_path, entity, pdf, name=None, fmt="csv"):
    d = tmp_path / "src" / entity
    d.mkdir(parents=True, exist_ok=True)
    p = d / (name or f"{entity}.{fmt}")
    if fmt == "csv":
        pdf.to_csv(p, index=False)
    else:
        pdf.to_parquet(p, index=False)
    return str(tmp_path / "src")


def test_partitioned_key_format():
    assert partitioned_key("transactions", dt.date(2024, 3, 5), "transactions.csv") == \
        "transactions/year=2024/month=03/day=05/transactions.csv"
    assert partitioned_key("customers", dt.date(2024, 1, 1), "c.csv") == partitioned_key("customers", "2024-01-01", "c.csv")


def test_valid_file_lands_in_raw(spark, good_customers, tmp_path):
    src = write_source(tmp_path, "customers", good_customers)
    raw = str(tmp_path / "raw")
    out = ingest(spark, src, raw, D, advance_watermark=False)
    assert [m["accepted"] for m in out.manifest] == [True]
    assert out.manifest[0]["key"] == "customers/year=2024/month=03/day=15/customers.csv"
    assert all(f.startswith("customers/year=2024/month=03/day=15/source_file=customers.csv/") for f in files_under(raw))
    back = read_raw(spark, raw, "customers", D)
    assert back.count() == 2
    assert {f.name: f.dataType.simpleString() for f in back.schema.fields}["age"] == "string"
    assert back.select("year", "month", "day").distinct().collect()[0].asDict() == {"year": "2024", "month": "03", "day": "15"}


def test_ingest_is_idempotent(spark, good_customers, tmp_path):
    src = write_source(tmp_path, "customers", good_customers)
    raw = str(tmp_path / "raw")
    for _ in range(3):
        ingest(spark, src, raw, D, advance_watermark=False)
    assert read_raw(spark, raw, "customers").count() == 2
    assert len(files_under(raw)) == 1


def test_invalid_file_is_dead_lettered_with_manifest(spark, good_customers, tmp_path):
    bad = good_customers.copy()
    bad.loc[0, "credit_score"] = 9999
    src = write_source(tmp_path, "customers", bad)
    raw = str(tmp_path / "raw")
    out = ingest(spark, src, raw, D, advance_watermark=False)
    m = out.manifest[0]
    assert not m["accepted"] and m["key"].startswith("_dead_letter/")
    assert read_raw(spark, raw, "customers", dead_letter=True).count() == 2
    man = [f for f in files_under(raw) if f.endswith(".json")]
    assert len(man) == 1 and man[0].startswith("_dead_letter/_manifests/customers/year=2024/month=03/day=15/source_file=customers.csv/")
    doc = json.loads(json.loads(open(os.path.join(raw, man[0])).read())["manifest_json"])
    assert doc["is_valid"] is False and doc["violations"]


def test_rejected_file_does_not_land_in_main_zone(spark, good_customers, tmp_path):
    bad = good_customers.copy()
    bad.loc[0, "segment"] = "platinum"
    src = write_source(tmp_path, "customers", bad)
    raw = str(tmp_path / "raw")
    ingest(spark, src, raw, D, advance_watermark=False)
    assert [f for f in files_under(raw) if not f.startswith("_dead_letter")] == []
    assert read_raw(spark, raw, "customers") is None


def test_replay_of_fixed_file_lands_and_keeps_old_quarantine(spark, good_customers, tmp_path):
    bad = good_customers.copy()
    bad.loc[0, "segment"] = "platinum"
    src = write_source(tmp_path, "customers", bad)
    raw = str(tmp_path / "raw")
    ingest(spark, src, raw, D, advance_watermark=False)
    write_source(tmp_path, "customers", good_customers)
    out = ingest(spark, src, raw, D, advance_watermark=False)
    assert out.manifest[0]["accepted"]
    assert read_raw(spark, raw, "customers", D).count() == 2
    assert read_raw(spark, raw, "customers", D, dead_letter=True).count() == 2


def test_several_files_a_day_stay_separate_and_stage_as_union(spark, good_customers, tmp_path):
    src = write_source(tmp_path, "customers", good_customers, "a.csv")
    other = good_customers.copy()
    other["customer_id"] = ["CUST_00000003", "CUST_00000004"]
    write_source(tmp_path, "customers", other, "b.csv")
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    out = ingest(spark, src, raw, D, advance_watermark=False)
    assert [m["source_file"] for m in out.accepted] == ["a.csv", "b.csv"]
    res = stage(spark, raw, staged, D, ["customers"])
    assert sorted((r["source_key"], r["rows"]) for r in res) == [
        ("customers/year=2024/month=03/day=15/a.csv", 2), ("customers/year=2024/month=03/day=15/b.csv", 2)]
    assert read_staged(spark, staged, "customers", D).count() == 4


def test_stage_writes_typed_parquet(spark, good_customers, tmp_path):
    src = write_source(tmp_path, "customers", good_customers)
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    ingest(spark, src, raw, D, advance_watermark=False)
    res = stage(spark, raw, staged, D, ["customers"])
    assert len(res) == 1 and res[0]["rows"] == 2
    assert res[0]["target_key"] == "customers/year=2024/month=03/day=15/"
    assert all(f.startswith("customers/year=2024/month=03/day=15/") for f in files_under(staged))
    df = read_staged(spark, staged, "customers", D)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types["credit_score"] == "bigint" and types["annual_income"] == "double" and types["join_date"] == "date"
    assert types["segment"] == "string"
    # staging twice replaces the day
    stage(spark, raw, staged, D, ["customers"])
    assert read_staged(spark, staged, "customers", D).count() == 2


def test_apply_contract_types_casts_correctly(spark, good_customers):
    df = spark.createDataFrame(good_customers.astype(str))
    typed = apply_contract_types(df, load_contract("customers"))
    types = dict(typed.dtypes)
    assert types["credit_score"] == "bigint" and types["annual_income"] == "double" and types["join_date"] == "date"
    row = typed.orderBy("customer_id").first()
    assert row["join_date"] == dt.date(2020, 1, 15) and row["credit_score"] == 720


def test_typing_coerces_and_rejects_fractions(spark):
    from contractgate.operators.contract import Contract
    c = Contract.from_dict({"entity": "t", "version": "1", "columns": [
        {"name": "i", "type": "integer"}, {"name": "f", "type": "float"}, {"name": "b", "type": "boolean"},
        {"name": "t", "type": "timestamp"}, {"name": "d", "type": "date"}]})
    df = spark.createDataFrame([
        ("12345678901234567", "1e3", "TRUE", "2024-03-15T10:00:00+02:00", "2020-02-30"),
        ("5.0", "abc", "0", "2024-03-15 10:00:00", "20240315"),
        ("n/a", None, "yes", "now", "03/15/2024"),
    ], "i string, f string, b string, t string, d string")
    rows = apply_contract_types(df, c).collect()
    assert [r["i"] for r in rows] == [12345678901234567, 5, None]
    assert [r["f"] for r in rows] == [1000.0, None, None]
    assert [r["b"] for r in rows] == [True, False, None]
    assert [r["t"] for r in rows] == [dt.datetime(2024, 3, 15, 8, 0), dt.datetime(2024, 3, 15, 10, 0), None]
    assert [r["d"] for r in rows] == [None, dt.date(2024, 3, 15), dt.date(2024, 3, 15)]
    frac = spark.createDataFrame([("2.5",)], "i string")
    with pytest.raises(Exception, match="non-whole"):
        apply_contract_types(frac, c).collect()


def test_parquet_source_keeps_types(spark, good_customers, tmp_path):
    src = write_source(tmp_path, "customers", good_customers, fmt="parquet")
    raw = str(tmp_path / "raw")
    out = ingest(spark, src, raw, D, advance_watermark=False)
    assert out.manifest[0]["accepted"] and out.manifest[0]["source_file"] == "customers.parquet"
    types = dict(read_raw(spark, raw, "customers").dtypes)
    assert types["age"] == "bigint" and types["dti"] == "double"


def test_discovery_skips_entities_without_contract_and_filters(spark, good_customers, tmp_path):
    src = write_source(tmp_path, "customers", good_customers)
    write_source(tmp_path, "mystery", good_customers)
    (tmp_path / "src" / "empty_entity").mkdir()
    raw = str(tmp_path / "raw")
    out = ingest(spark, src, raw, D, advance_watermark=False)
    assert out.skipped_entities == ["mystery"] and [m["entity"] for m in out.manifest] == ["customers"]
    assert ingest(spark, src, raw, D, entities=["branches"], advance_watermark=False).manifest == []
    assert len(ingest(spark, src, raw, D, entities=[], advance_watermark=False).manifest) == 1


def test_watermarks(spark, tmp_path):
    store = WatermarkStore(spark, str(tmp_path / "raw"))
    assert store.get("customers") is None
    store.set("customers", dt.date(2024, 3, 15))
    assert store.get("customers") == dt.date(2024, 3, 15)
    assert store.advance("customers", dt.date(2024, 3, 10)) == dt.date(2024, 3, 15)
    assert store.get("customers") == dt.date(2024, 3, 15)
    assert store.advance("customers", dt.date(2024, 3, 20)) == dt.date(2024, 3, 20)
    store.set("customers", dt.date(2024, 1, 1))  # set may rewind
    assert store.get("customers") == dt.date(2024, 1, 1)


def test_ingest_advances_watermark_and_report(spark, good_customers, tmp_path):
    src = write_source(tmp_path, "customers", good_customers)
    raw = str(tmp_path / "raw")
    ingest(spark, src, raw, D)
    ingest(spark, src, raw, dt.date(2024, 3, 1))
    rep = {r["entity"]: r["watermark"] for r in watermark_report(spark, raw).collect()}
    assert rep == {"accounts": "(never loaded)", "branches": "(never loaded)", "customers": "2024-03-15",
                   "loans": "(never loaded)", "transactions": "(never loaded)"}


def test_run_load_audits_and_gates_staging(spark, good_customers, tmp_path):
    from contractgate.operators.state import LoadLog
    src = write_source(tmp_path, "customers", good_customers)
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    outcome, staged_rows = run_load(spark, src, raw, staged, D)
    assert staged_rows[0]["rows"] == 2
    bad = good_customers.copy()
    bad.loc[0, "dti"] = 5.0
    write_source(tmp_path, "customers", bad)
    with pytest.raises(RuntimeError):
        run_load(spark, src, raw, str(tmp_path / "staged2"), D)
    assert not os.path.exists(tmp_path / "staged2")
    status = sorted((r["status"], r["rows_loaded"]) for r in LoadLog(spark, raw).status().collect())
    assert status == [("failed", 0), ("success", 2)]


def test_summary_and_totals(spark, good_customers, tmp_path):
    src = write_source(tmp_path, "customers", good_customers, "a.csv")
    bad = good_customers.copy()
    bad.loc[0, "age"] = 7
    write_source(tmp_path, "customers", bad, "b.csv")
    out = ingest(spark, src, str(tmp_path / "raw"), D, advance_watermark=False)
    m = out.to_df(spark)
    lines = sorted(r["summary"] for r in summary(m).collect())
    assert lines == ["ACCEPTED customers: 2 rows -> customers/year=2024/month=03/day=15/a.csv",
                     "REJECTED customers: 2 rows -> _dead_letter/customers/year=2024/month=03/day=15/b.csv"]
    assert sorted((r["accepted"], r["files"], r["rows"]) for r in totals(m).collect()) == [(False, 1, 2), (True, 1, 2)]


def test_parquet_files_with_different_schemas_are_scanned_apart(spark, good_customers, tmp_path):
    write_source(tmp_path, "customers", good_customers, "a.parquet", fmt="parquet")
    other = good_customers[list(reversed(good_customers.columns))].copy()
    other["customer_id"] = ["CUST_00000005", "CUST_00000006"]
    other["age"] = other["age"].astype(str)  # text ages in this file
    src = write_source(tmp_path, "customers", other, "b.parquet", fmt="parquet")
    out = ingest(spark, src, str(tmp_path / "raw"), D, advance_watermark=False)
    assert [(m["source_file"], m["accepted"], m["rows"]) for m in out.manifest] == [
        ("a.parquet", True, 2), ("b.parquet", True, 2)]


def test_stage_reports_silent_coercions(spark, good_customers, tmp_path):
    from contractgate.operators.contract import Contract
    import json as _json
    cdir = tmp_path / "contracts"
    cdir.mkdir()
    (cdir / "t.json").write_text(_json.dumps({"entity": "t", "version": "1", "columns": [
        {"name": "a", "type": "string"}, {"name": "d", "type": "string"}]}))
    src = tmp_path / "src" / "t"
    src.mkdir(parents=True)
    (src / "t.csv").write_text("a,d\n1,2024-01-01\nx,not a date\n")
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    ingest(spark, str(tmp_path / "src"), raw, D, contracts_dir=str(cdir), advance_watermark=False)
    # the staging contract is stricter than the landing one: a is an integer, d a date
    (cdir / "t.json").write_text(_json.dumps({"entity": "t", "version": "2", "columns": [
        {"name": "a", "type": "integer"}, {"name": "d", "type": "date"}]}))
    res = stage(spark, raw, staged, D, ["t"], str(cdir))
    assert res[0]["rows"] == 2 and res[0]["coerced"] == {"a": 1, "d": 1}


def test_stage_manifest_totals(spark, good_customers, tmp_path):
    from contractgate.plans.ingest import stage_manifest, staged_total
    src = write_source(tmp_path, "customers", good_customers, "a.csv")
    write_source(tmp_path, "customers", good_customers.assign(customer_id=["CUST_00000009", "CUST_00000010"]), "b.csv")
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    ingest(spark, src, raw, D, advance_watermark=False)
    m = stage_manifest(spark, stage(spark, raw, staged, D, ["customers"]))
    assert {r["entity"]: r["rows"] for r in staged_total(m).collect()} == {None: 4, "customers": 4}


def test_incremental_filter_per_entity(spark, tmp_path):
    from contractgate.operators.state import incremental
    store = WatermarkStore(spark, str(tmp_path / "raw"))
    store.set("a", dt.date(2024, 1, 10))
    df = spark.createDataFrame([("a", dt.date(2024, 1, 9)), ("a", dt.date(2024, 1, 11)), ("b", dt.date(2020, 1, 1))],
                               "entity string, d date")
    got = sorted((r["entity"], r["d"]) for r in incremental(df, store.current(), "d", "entity").collect())
    assert got == [("a", dt.date(2024, 1, 11)), ("b", dt.date(2020, 1, 1))]


def test_empty_parquet_file_is_quarantined(spark, good_customers, tmp_path):
    src = write_source(tmp_path, "customers", good_customers, "a.parquet", fmt="parquet")
    (tmp_path / "src" / "customers" / "z.parquet").write_bytes(b"")
    out = ingest(spark, src, str(tmp_path / "raw"), D, advance_watermark=False)
    got = {m["source_file"]: (m["accepted"], m["rows"]) for m in out.manifest}
    assert got == {"a.parquet": (True, 2), "z.parquet": (False, 0)}


def test_state_tables_compact_to_the_same_answers(spark, tmp_path):
    from contractgate.operators.state import LoadLog
    root = str(tmp_path / "raw")
    store = WatermarkStore(spark, root)
    store.set("a", dt.date(2024, 1, 5))
    for d in (3, 9, 7):
        store.advance("a", dt.date(2024, 1, d))
    store.advance("b", dt.date(2023, 5, 1))
    before = sorted(tuple(r) for r in store.current().collect())
    store.compact()
    assert sorted(tuple(r) for r in store.current().collect()) == before
    assert store.events().count() == 2 and len(store.events().inputFiles()) == 1
    assert store.advance("a", dt.date(2024, 1, 8)) == dt.date(2024, 1, 9)  # still forward only

    log = LoadLog(spark, root)
    lid = log.start("p", "t")
    log.finish(lid, 5)
    log.start("p", "t2")
    status = sorted((r["status"], r["rows_loaded"]) for r in log.status().collect())
    log.compact()
    assert sorted((r["status"], r["rows_loaded"]) for r in log.status().collect()) == status


def test_rows_with_a_null_batch_key_are_routed_not_dropped(spark, tmp_path):
    from pyspark.sql import functions as F
    from contractgate.operators.contract import Contract
    from contractgate.operators.route import route
    from contractgate.operators.validate import validate
    from contractgate.plans.batches import gate_by_day, with_batches
    c = Contract.from_dict({"entity": "t", "version": "1", "columns": [{"name": "v", "type": "integer", "max": 5},
                                                                      {"name": "d"}]})
    df = spark.createDataFrame([(1, "2024-01-01"), (2, None), (9, "2024-01-02"), (3, None)], "v int, d string")
    batched = df.withColumn("b", F.col("d"))
    v = validate(batched, c, ["b"])
    acc, rej = route(batched, v.verdicts, ["b"])
    assert acc.count() + rej.count() == 4 and acc.count() == 3
    raw = str(tmp_path / "raw")
    gate = gate_by_day(spark, with_batches(df, F.to_date("d"), F.lit("t.csv")), c, raw, "t")
    from contractgate.sources.scans import read_raw
    assert read_raw(spark, raw, "t").count() == 3
    assert read_raw(spark, raw, "t", dead_letter=True).count() == 1
    assert len(gate.verdicts) == 3


def test_reserved_names_of_all_kinds_survive(spark, tmp_path):
    from contractgate.operators.contract import Contract
    from contractgate.plans.batches import gate_by_day, with_batches
    from contractgate.sources.scans import read_raw
    from pyspark.sql import functions as F
    names = ["id", "year", "month", "day", "source_file", "_extra", "__data_x"]
    c = Contract.from_dict({"entity": "t", "version": "1", "columns": [{"name": n} for n in names]})
    df = spark.createDataFrame([("1", "1999", "m", "Mon", "hello", "e", "d")], ", ".join(f"`{n}` string" for n in names))
    raw = str(tmp_path / "raw")
    gate_by_day(spark, with_batches(df, F.lit("2024-03-15"), F.lit("y.csv")), c, raw, "t")
    row = read_raw(spark, raw, "t").first().asDict()
    assert [row[n] for n in names] == ["1", "1999", "m", "Mon", "hello", "e", "d"]
    assert [row[f"load_{n}"] for n in ("year", "month", "day", "source_file")] == ["2024", "03", "15", "y.csv"]


def test_relanding_replaces_only_its_own_files(spark, tmp_path):
    from contractgate.sinks.zones import land
    from contractgate.sources.scans import read_raw
    from pyspark.sql import functions as F
    raw = str(tmp_path / "raw")
    a = spark.createDataFrame([(1, "a.csv"), (2, "b.csv")], "v int, f string")
    land(a, raw, "t", "2024-03-15", "f")
    land(a.where("f = 'b.csv'").withColumn("v", F.lit(9)), raw, "t", "2024-03-15", "f")
    land(a.where("false"), raw, "t", "2024-03-15", "f")
    assert sorted((r.v, r.source_file) for r in read_raw(spark, raw, "t").collect()) == [(1, "a.csv"), (9, "b.csv")]
    assert not [p for p in (tmp_path / "raw" / "t").iterdir() if p.name.startswith("_new")]


def test_compaction_survives_a_crash_before_the_old_files_go(spark, tmp_path, monkeypatch):
    from contractgate.operators import state
    store = WatermarkStore(spark, str(tmp_path / "raw"))
    for d in (3, 9, 7):
        store.advance("a", dt.date(2024, 1, d))
    events = store.events()
    current = state.current_watermarks(events).join(events.groupBy("entity").agg({"seq": "max"}).withColumnRenamed("max(seq)", "seq"), "entity")
    current.selectExpr("entity", "seq", "'set' op", "watermark").coalesce(1).write.mode("append").parquet(store.path)
    assert store.get("a") == dt.date(2024, 1, 9)  # old and compacted events together


def test_dates_need_a_four_digit_year_and_a_date(spark):
    from contractgate.functions.coerce import to_timestamp
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    df = spark.createDataFrame([(x,) for x in ("12345", "202001", "T12:30:00Z", "99999-01-01", "2020-01-15", "2020-01-15T10:00:00+02:00")], "s string")
    got = [r[0] for r in df.select(F.expr(to_timestamp("s", T.StringType()))).collect()]
    assert got == [None, None, None, None, dt.datetime(2020, 1, 15), dt.datetime(2020, 1, 15, 8)]
    n = spark.createDataFrame([(1579046400000000000, 1.5e18), (20200115, float("nan")), (-1, float("inf"))], "n bigint, d double")
    rows = n.select(F.expr(to_timestamp("n", T.LongType())), F.expr(to_timestamp("d", T.DoubleType()))).collect()
    assert [r[0] for r in rows] == [dt.datetime(2020, 1, 15), dt.datetime(1970, 1, 1, 0, 0, 0, 20200), dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    assert [r[1] for r in rows] == [dt.datetime(2017, 7, 14, 2, 40), None, None]


def test_an_unknown_format_is_an_error(spark, tmp_path):
    import pytest
    from contractgate.plans.ingest import ingest_files
    from contractgate.sources.files import SourceFile
    with pytest.raises(ValueError, match="neither CSV nor Parquet"):
        ingest_files(spark, [SourceFile("customers", str(tmp_path / "a.xml"), "a.xml", None)], str(tmp_path / "raw"), D)
