"""Malformed and adversarial CSV inputs: read as received, quarantine what
would otherwise be lost or shifted."""
import datetime as dt
import json

from contractgate.plans.ingest import ingest
from contractgate.sinks.zones import EXTRA
from contractgate.sources.files import csv_header, list_source_files, mangle_names
from contractgate.sources.scans import read_csv_strict, read_raw

D = dt.date(2024, 3, 15)
AB = {"entity": "ab", "version": "1", "columns": [{"name": "a"}, {"name": "b"}]}


def contracts_dir(tmp_path, contract=AB):
    d = tmp_path / "contracts"
    d.mkdir(exist_ok=True)
    (d / f"{contract['entity']}.json").write_text(json.dumps(contract))
    return str(d)


def source(tmp_path, name, content, entity="ab"):
    d = tmp_path / "src" / entity
    d.mkdir(parents=True, exist_ok=True)
    (d / name).write_bytes(content.encode() if isinstance(content, str) else content)
    return str(tmp_path / "src")


def test_values_read_as_received(spark, tmp_path):
    src = source(tmp_path, "f.csv", 'a,b\n"",x\n,y\nNA,nan\n\n1\n"x ""q"" y",2\n"multi\nline",3\n')
    df = read_csv_strict(spark, [src + "/ab/f.csv"], ["a", "b"])
    rows = [(r["a"], r["b"], r[EXTRA]) for r in df.collect()]
    assert rows == [(None, "x", None), (None, "y", None), ("NA", "nan", None), ("1", None, None),
                    ('x "q" y', "2", None), ("multi\nline", "3", None)]


def test_extra_fields_quarantine(spark, tmp_path):
    src = source(tmp_path, "f.csv", "a,b\n1,2\n1,2,3\n")
    out = ingest(spark, src, str(tmp_path / "raw"), D, contracts_dir=contracts_dir(tmp_path), advance_watermark=False)
    m = out.manifest[0]
    assert not m["accepted"]
    doc = json.loads(m["manifest_json"])
    assert doc["violations"] == [{"check": "schema", "column": None,
                                  "message": "rows with more fields than the header", "failing_rows": 1}]
    # the extra value is kept in the dead-letter copy
    dl = read_raw(spark, str(tmp_path / "raw"), "ab", D, dead_letter=True)
    assert sorted(r["_extra"] or "" for r in dl.collect()) == ["", "3"]


def test_header_only_file_is_valid_and_empty_file_is_quarantined(spark, tmp_path):
    source(tmp_path, "h.csv", "a,b\n")
    src = source(tmp_path, "z.csv", "")
    out = ingest(spark, src, str(tmp_path / "raw"), D, contracts_dir=contracts_dir(tmp_path), advance_watermark=False)
    got = {m["source_file"]: (m["accepted"], m["rows"]) for m in out.manifest}
    assert got == {"h.csv": (True, 0), "z.csv": (False, 0)}
    z = json.loads([m for m in out.manifest if m["source_file"] == "z.csv"][0]["manifest_json"])
    assert z["violations"][0]["message"] == "missing columns: ['a', 'b']"


def test_zero_row_file_replaces_earlier_load(spark, tmp_path):
    raw = str(tmp_path / "raw")
    cdir = contracts_dir(tmp_path)
    src = source(tmp_path, "f.csv", "a,b\n1,2\n3,4\n")
    ingest(spark, src, raw, D, contracts_dir=cdir, advance_watermark=False)
    assert read_raw(spark, raw, "ab", D).count() == 2
    source(tmp_path, "f.csv", "a,b\n")
    ingest(spark, src, raw, D, contracts_dir=cdir, advance_watermark=False)
    assert read_raw(spark, raw, "ab", D).count() == 0


def test_duplicate_header_names(spark, tmp_path):
    assert mangle_names(["a", "a", "", "a"]) == ["a", "a.1", "Unnamed: 2", "a.2"]
    src = source(tmp_path, "f.csv", "a,a\n1,2\n")
    out = ingest(spark, src, str(tmp_path / "raw"), D, contracts_dir=contracts_dir(tmp_path), advance_watermark=False)
    doc = json.loads(out.manifest[0]["manifest_json"])
    assert [v["message"] for v in doc["violations"]] == ["missing columns: ['b']", "unexpected columns: ['a.1']"]


def test_files_with_different_headers_are_read_each_with_its_own(spark, tmp_path):
    c = {"entity": "ab", "version": "1", "columns": [{"name": "a", "type": "integer", "max": 5}, {"name": "b"}]}
    cdir = contracts_dir(tmp_path, c)
    source(tmp_path, "f1.csv", "a,b\n1,x\n")
    src = source(tmp_path, "f2.csv", "b,a\ny,2\n")
    raw = str(tmp_path / "raw")
    out = ingest(spark, src, raw, D, contracts_dir=cdir, advance_watermark=False)
    assert [m["accepted"] for m in out.manifest] == [True, True]
    rows = sorted((r["source_file"], r["a"], r["b"]) for r in read_raw(spark, raw, "ab", D).collect())
    assert rows == [("f1.csv", "1", "x"), ("f2.csv", "2", "y")]


def test_header_with_quotes_and_bom(spark, tmp_path):
    src = source(tmp_path, "f.csv", '﻿"a","b ""x"""\n1,2\n')
    assert csv_header(spark, src + "/ab/f.csv") == ["a", 'b "x"']


def test_listing_sorted_and_layout(spark, tmp_path):
    source(tmp_path, "b.csv", "a,b\n")
    source(tmp_path, "a.parquet", b"")
    source(tmp_path, "notes.txt", "x")
    src = source(tmp_path, "x.csv", "a,b\n", entity="other")
    got = [(f.entity, f.name, f.fmt) for f in list_source_files(spark, src)]
    assert got == [("ab", "a.parquet", "parquet"), ("ab", "b.csv", "csv"), ("other", "x.csv", "csv")]


def test_single_line_mode(spark, tmp_path):
    src = source(tmp_path, "f.csv", "a,b\n1,2\n3,4\n")
    out = ingest(spark, src, str(tmp_path / "raw"), D, contracts_dir=contracts_dir(tmp_path),
                 advance_watermark=False, multi_line=False)
    assert out.manifest[0]["accepted"] and out.manifest[0]["rows"] == 2


def test_headers_of_any_number_and_length(spark, tmp_path):
    import contractgate.sources.files as sf
    source(tmp_path, "f1.csv", "a,b\n1,x\n")
    source(tmp_path, "f2.csv", "\n\nb,a\ny,2\n3,4\n")
    source(tmp_path, "f3.csv", "a,a\n1,2\n")
    source(tmp_path, "f4.csv", "")
    source(tmp_path, "f5.csv", '"a\nb",c\n1,2\n')
    long = [f"column_{i:07d}" for i in range(120_000)]  # longer than any read buffer
    src = source(tmp_path, "f6.csv", ",".join(long) + "\n")
    files = sf.list_source_files(spark, src)
    got = sf.file_columns(spark, files)
    assert [got[f.path][0] for f in files] == [["a", "b"], ["b", "a"], ["a", "a.1"], [], ["a\nb", "c"], long]


def test_auto_mode_reads_only_quoted_newline_files_multiline(spark, tmp_path):
    from contractgate.sources.scans import files_with_quoted_newlines
    source(tmp_path, "plain.csv", 'a,b\n1,"x ""y"""\n2,z\n')
    src = source(tmp_path, "multi.csv", 'a,b\n"multi\nline",3\n4,5\n')
    paths = [f"{src}/ab/plain.csv", f"{src}/ab/multi.csv"]
    assert files_with_quoted_newlines(spark, paths) == {f"{src}/ab/multi.csv"}
    out = ingest(spark, src, str(tmp_path / "raw"), D, contracts_dir=contracts_dir(tmp_path), advance_watermark=False)
    assert {m["source_file"]: m["rows"] for m in out.manifest} == {"multi.csv": 2, "plain.csv": 2}
    rows = sorted((r["source_file"], r["a"], r["b"]) for r in read_raw(spark, str(tmp_path / "raw"), "ab", D).collect())
    assert rows == [("multi.csv", "4", "5"), ("multi.csv", "multi\nline", "3"),
                    ("plain.csv", "1", 'x "y"'), ("plain.csv", "2", "z")]


def test_entity_without_files_is_warned(spark, tmp_path, caplog):
    import logging
    from contractgate.sources.files import list_source_files
    src = source(tmp_path, "f.csv", "a,b\n")
    (tmp_path / "src" / "empty").mkdir()
    with caplog.at_level(logging.WARNING, logger="contractgate.sources"):
        files = list_source_files(spark, src)
    assert [f.entity for f in files] == ["ab"]
    assert "no data files for entity empty" in caplog.text


def test_many_header_groups_in_chunked_jobs(spark, tmp_path, monkeypatch):
    import contractgate.plans.ingest as ing
    monkeypatch.setattr(ing, "GROUPS_PER_JOB", 1)
    source(tmp_path, "f1.csv", "a,b\n1,x\n")
    source(tmp_path, "f2.csv", "b,a\ny,2\n")
    src = source(tmp_path, "f3.csv", "a,b,c\n1,2,3\n")
    out = ingest(spark, src, str(tmp_path / "raw"), D, contracts_dir=contracts_dir(tmp_path), advance_watermark=False)
    assert [(m["source_file"], m["accepted"]) for m in out.manifest] == [("f1.csv", True), ("f2.csv", True), ("f3.csv", False)]


def test_zero_row_file_with_an_awkward_name_replaces_its_own_rows(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for content in ("a,b\n1,2\n", "a,b\n"):
        src = source(tmp_path, "100% [x] y.csv", content)
        out = ingest(spark, src, raw, D, contracts_dir=contracts_dir(tmp_path), advance_watermark=False)
        assert out.manifest[0]["accepted"]
    assert read_raw(spark, raw, "ab", D).count() == 0
