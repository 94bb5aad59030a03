"""Loads are published whole: a crash between any two steps leaves the old or the new rows."""
import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from contractgate.operators.state import WatermarkStore
from contractgate.sinks import zones
from contractgate.sources.files import claim_number
from contractgate.sources.scans import read_raw


def _rows(spark, raw):
    df = read_raw(spark, raw, "t")
    return sorted((r.v, r.source_file) for r in df.collect()) if df is not None else []


class Killed(Exception):
    pass


@pytest.mark.parametrize("step,new", [("begin_load", False), ("_written", False), ("publish", False), ("claim_number", False), ("_remove", True)])
def test_a_crash_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step, new):
    raw = str(tmp_path / "raw")
    files = spark.createDataFrame([(1, "a.csv"), (2, "a.csv"), (3, "b.csv")], "v int, f string")
    zones.land(files, raw, "t", "2024-03-15", "f")

    def killed(*_, **__):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(zones, step, killed)
        with pytest.raises(Killed):
            zones.land(files.where("f = 'a.csv'").withColumn("v", F.col("v") + 10), raw, "t", "2024-03-15", "f")
    after = [(3, "b.csv"), (11, "a.csv"), (12, "a.csv")] if new else [(1, "a.csv"), (2, "a.csv"), (3, "b.csv")]
    assert _rows(spark, raw) == after
    zones.vacuum(spark, f"{raw}/t")
    assert _rows(spark, raw) == after
    assert len([p for p in (tmp_path / "raw" / "t").rglob("__load=*") if p.is_dir()]) == 2  # one a partition
    # the load is run again
    zones.land(files.where("f = 'a.csv'").withColumn("v", F.col("v") + 10), raw, "t", "2024-03-15", "f")
    assert _rows(spark, raw) == [(3, "b.csv"), (11, "a.csv"), (12, "a.csv")]


def test_a_crash_of_the_first_load_shows_nothing(spark, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    df = spark.createDataFrame([(1, "a.csv")], "v int, f string")

    def killed(*_, **__):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(zones, "publish", killed)
        with pytest.raises(Killed):
            zones.land(df, raw, "t", "2024-03-15", "f")
    assert _rows(spark, raw) == []
    assert zones.vacuum(spark, f"{raw}/t") == 1
    assert _rows(spark, raw) == []


def test_partitions_without_a_date_and_with_odd_names_are_replaced(spark, tmp_path):
    raw = str(tmp_path / "raw")
    rows = spark.createDataFrame([(1, "a b=c%.csv", None), (2, "x/y.csv", dt.date(2024, 1, 2))], "v int, f string, d date")
    for add in (0, 10):
        zones.land(rows.withColumn("v", F.col("v") + add), raw, "t", F.col("d"), "f")
    assert _rows(spark, raw) == [(11, "a b=c%.csv"), (12, "x/y.csv")]
    assert len([p for p in (tmp_path / "raw" / "t").rglob("__load=*") if p.is_dir()]) == 2


def test_a_claimed_number_is_no_one_else_s(spark, tmp_path):
    got = []

    def claim():
        for _ in range(15):
            got.append(claim_number(spark, str(tmp_path / "claims")))

    threads = [threading.Thread(target=claim) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == list(range(1, 61))
    assert claim_number(spark, str(tmp_path / "claims"), floor=500) == 501


def test_watermark_events_are_ordered_by_call_not_by_clock(spark, tmp_path, monkeypatch):
    import time
    clock = time.time_ns
    stores = [WatermarkStore(spark, str(tmp_path / "raw")) for _ in range(2)]
    monkeypatch.setattr(time, "time_ns", lambda: clock() + 3_600_000_000_000)
    stores[0].set("a", "2024-05-01")  # by a clock one hour ahead
    monkeypatch.setattr(time, "time_ns", clock)
    stores[1].set("a", "2024-02-01")
    assert stores[0].get("a") == dt.date(2024, 2, 1)
    stores[0].advance("a", "2024-03-01")
    stores[1].compact()
    assert stores[1].get("a") == dt.date(2024, 3, 1)
