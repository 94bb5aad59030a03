"""Landed rows against received rows."""
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contractgate.operators.reconcile import ReconciliationError, reconciliation
from contractgate.sinks import zones
from contractgate.sources.scans import read_raw

ROWS = "__source_file string, k bigint, a string, b string"


def _rows(spark, *values):
    return spark.createDataFrame([(f, k, a, b) for f, k, a, b in values], ROWS)


def test_digests_see_lost_doubled_and_moved_values(spark):
    received = _rows(spark, ("x", 1, "p", None), ("x", 2, "q", "r"), ("y", 1, "p", "p"), ("z", 1, None, "s"), (None, 1, "t", None))
    landed = _rows(spark, ("x", 2, "q", "r"), ("x", 1, "p", None), ("y", 1, "p", "p"), ("y", 1, "p", "p"), ("z", 1, "s", None), ("w", 1, "u", "v"))
    found = {r[0]: tuple(r)[1:] for r in reconciliation(received, landed, ["__source_file"]).collect()}
    assert found == {"x": (2, 2, True), "y": (1, 2, False), "z": (1, 1, False), "w": (0, 1, False), None: (1, 0, False)}


def test_equal_batches_of_equal_rows_and_of_maps(spark):
    received = spark.createDataFrame([("x", {"a": 1, "b": 2}), ("x", {"a": 1, "b": 2}), ("y", None)], "f string, m map<string,int>")
    swapped = spark.createDataFrame([("x", {"b": 2, "a": 1}), ("y", None), ("x", {"a": 1, "b": 2})], "f string, m map<string,int>")
    assert all(r.matches for r in reconciliation(received, swapped, ["f"]).collect())
    assert reconciliation(received.limit(0), swapped.limit(0), ["f"]).count() == 0


@pytest.mark.parametrize("fault", ["lost", "doubled"])
def test_a_faulty_write_is_not_published(spark, tmp_path, monkeypatch, fault):
    root = str(tmp_path / "raw")
    old, new = (_rows(spark, *[(f, k, a, None) for f in "xy" for k in range(20)]).repartition(2) for a in ("old", "new"))
    zones.land(old, root, "things", "2024-03-15", reconciled=True)

    def spoil(spark, path, load):
        part = next(Path(path).rglob(f"source_file=x/{zones.LOAD}={load}/part-*.parquet"))
        if fault == "doubled":
            shutil.copy(part, part.with_name("part-again.parquet"))
        else:
            part.with_name(f".{part.name}.crc").unlink()
            part.write_bytes(next(Path(empty).glob("part-*.parquet")).read_bytes())

    empty = str(tmp_path / "empty")
    new.limit(0).drop("__source_file").write.parquet(empty)
    with monkeypatch.context() as patched:
        patched.setattr(zones, "_tidy", spoil)
        with pytest.raises(ReconciliationError):
            zones.land(new, root, "things", "2024-03-15", reconciled=True)
    assert [tuple(r) for r in read_raw(spark, root, "things").groupBy("a").count().collect()] == [("old", 40)]
    zones.land(new, root, "things", "2024-03-15", reconciled=True)
    assert [tuple(r) for r in read_raw(spark, root, "things").groupBy("a").agg(F.count("*")).collect()] == [("new", 40)]
