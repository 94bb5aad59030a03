"""The command line runs the jobs and reports through exit codes."""

from contractgate.__main__ import main


def test_cli_ingest_stage_watermarks(spark, good_customers, tmp_path, capsys):
    src = tmp_path / "src" / "customers"
    src.mkdir(parents=True)
    good_customers.to_csv(src / "customers.csv", index=False)
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    assert main(["ingest", "--source", str(tmp_path / "src"), "--raw", raw, "--date", "2024-03-15"]) == 0
    assert "ACCEPTED customers: 2 rows -> customers/year=2024/month=03/day=15/customers.csv" in capsys.readouterr().out
    assert main(["stage", "--raw", raw, "--staged", staged, "--date", "2024-03-15"]) == 0
    assert "2 rows written to staged" in capsys.readouterr().out
    assert main(["watermarks", "--raw", raw]) == 0
    out = capsys.readouterr().out
    assert "customers        2024-03-15" in out and "loans            (never loaded)" in out
    bad = good_customers.copy()
    bad.loc[0, "age"] = 7
    bad.to_csv(src / "customers.csv", index=False)
    assert main(["ingest", "--source", str(tmp_path / "src"), "--raw", raw, "--date", "2024-03-16"]) == 1
    assert main(["run", "--source", str(tmp_path / "src"), "--raw", raw, "--staged", staged,
                 "--date", "2024-03-16"]) == 1


def test_cli_lint(tmp_path, capsys):
    import json
    assert main(["lint"]) == 0
    (tmp_path / "x.json").write_text(json.dumps({"entity": "x", "version": "1", "primary_key": ["nope"],
                                                 "columns": [{"name": "a", "min": 3, "max": 1}]}))
    assert main(["--contracts", str(tmp_path), "lint"]) == 1
    out = capsys.readouterr().out
    assert "x: a: min 3 is above max 1" in out and "primary key columns not in the contract: ['nope']" in out
