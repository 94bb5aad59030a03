"""Streaming landing: files gated as they arrive, each exactly once."""
import datetime as dt

from contractgate.sources.scans import read_raw
from contractgate.streaming.landing import stream_ingest

D = dt.date(2024, 3, 15)


def test_stream_gates_new_files_once(spark, good_customers, tmp_path):
    src = tmp_path / "src" / "customers"
    src.mkdir(parents=True)
    good_customers.to_csv(src / "a.csv", index=False)
    bad = good_customers.copy()
    bad.loc[0, "segment"] = "platinum"
    bad.to_csv(src / "b.csv", index=False)
    raw, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    outcomes = []
    q = stream_ingest(spark, str(tmp_path / "src"), "customers", raw, ckpt, load_date=D, outcomes=outcomes)
    q.awaitTermination(120)
    got = sorted((m["source_file"], m["accepted"]) for o in outcomes for m in o.manifest)
    assert got == [("a.csv", True), ("b.csv", False)]
    assert read_raw(spark, raw, "customers", D).count() == 2
    # a new file arrives: only it is processed by the next run
    other = good_customers.copy()
    other["customer_id"] = ["CUST_00000007", "CUST_00000008"]
    other.to_csv(src / "c.csv", index=False)
    outcomes.clear()
    q = stream_ingest(spark, str(tmp_path / "src"), "customers", raw, ckpt, load_date=D, outcomes=outcomes)
    q.awaitTermination(120)
    assert [m["source_file"] for o in outcomes for m in o.manifest] == ["c.csv"]
    assert read_raw(spark, raw, "customers", D).count() == 4
