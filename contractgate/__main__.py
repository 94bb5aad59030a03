"""Command line: ``python -m contractgate [--contracts DIR] [--master M] JOB OPTIONS``.

Jobs and their options are the table ``JOBS`` below; each job is one call of the
library. Exit code 0: done; 1: something was quarantined, failed or is wrong
with a contract. The session is ``SparkSession.builder.getOrCreate()``, so
cluster settings come from spark-submit; ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Iterator

from pyspark.sql import SparkSession

from .operators.contract import available_contracts, lint_contract, load_contract
from .operators.state import LoadLog, WatermarkStore
from .plans.ingest import ingest, run_load, stage, watermark_report
from .sinks.zones import as_date

# Option -> settings of its argument.
OPTIONS = {
    "source": {"required": True, "help": "folder with one folder of files per entity"},
    "raw": {"required": True, "help": "raw zone"},
    "staged": {"required": True, "help": "staged zone"},
    "date": {"required": True, "type": as_date, "help": "load date, yyyy-mm-dd"},
    "entities": {"nargs": "*", "help": "all if not given"},
    "no-watermark": {"action": "store_true", "help": "leave the watermarks as they are"},
    "multi-line": {"default": "auto", "choices": ("auto", "true", "false"), "help": "CSV fields with line ends"},
}


# Each job yields the lines it prints and returns whether all is well.
def _ingest(spark: SparkSession, o: argparse.Namespace) -> Iterator[str]:
    multi_line = o.multi_line if o.multi_line == "auto" else o.multi_line == "true"
    out = ingest(spark, o.source, o.raw, o.date, o.entities, o.contracts, not o.no_watermark, multi_line)
    for m in out.manifest:
        yield f"{'ACCEPTED' if m['accepted'] else 'REJECTED'} {m['entity']}: {m['rows']:,} rows -> {m['key']}"
    yield f"{len(out.accepted)} files landed, {len(out.rejected)} quarantined"
    return not out.rejected


def _stage(spark: SparkSession, o: argparse.Namespace) -> Iterator[str]:
    staged = stage(spark, o.raw, o.staged, o.date, o.entities, o.contracts)
    yield f"{sum(r['rows'] for r in staged)} rows written to staged"
    return True


def _run(spark: SparkSession, o: argparse.Namespace) -> Iterator[str]:
    try:
        run_load(spark, o.source, o.raw, o.staged, o.date, o.entities, o.contracts, not o.no_watermark)
    except Exception as err:  # noqa: BLE001 - the load log has it; a scheduler wants an exit code
        yield f"the load failed: {err}"
        return False
    return True


def _watermarks(spark: SparkSession, o: argparse.Namespace) -> Iterator[str]:
    for r in watermark_report(spark, o.raw, o.entities, o.contracts).orderBy("entity").collect():
        yield f"{r.entity:<16} {r.watermark}"
    return True


def _compact(spark: SparkSession, o: argparse.Namespace) -> Iterator[str]:
    for table in (WatermarkStore(spark, o.raw), LoadLog(spark, o.raw)):
        table.compact()
        yield f"compacted {table.path}"
    return True


def _lint(spark: None, o: argparse.Namespace) -> Iterator[str]:
    problems = [(e, p) for e in available_contracts(o.contracts) for p in lint_contract(load_contract(e, o.contracts))]
    for entity, problem in problems:
        yield f"{entity}: {problem}"
    return not problems


# Job -> (function, whether it needs a session, options).
JOBS = {
    "ingest": (_ingest, True, ("source", "raw", "date", "entities", "no-watermark", "multi-line")),
    "stage": (_stage, True, ("raw", "staged", "date", "entities")),
    "run": (_run, True, ("source", "raw", "staged", "date", "entities", "no-watermark")),
    "watermarks": (_watermarks, True, ("raw", "entities")),
    "compact": (_compact, True, ("raw",)),
    "lint": (_lint, False, ()),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="contractgate", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name, settings in {"contracts": {}, "master": {}, "log-level": {"default": "WARNING"}}.items():
        parser.add_argument(f"--{name}", **settings)
    jobs = parser.add_subparsers(dest="job", required=True)
    for job, (_, _, options) in JOBS.items():
        sub = jobs.add_parser(job)
        for name in options:
            sub.add_argument(f"--{name}", **OPTIONS[name])
    chosen = parser.parse_args(argv)
    logging.basicConfig(level=chosen.log_level)
    work, needs_session, _ = JOBS[chosen.job]
    spark = None
    if needs_session:
        builder = SparkSession.builder.appName("contractgate").config("spark.ui.enabled", "false")
        spark = (builder.master(chosen.master) if chosen.master else builder).getOrCreate()
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    lines = work(spark, chosen)
    while True:
        try:
            print(next(lines))
        except StopIteration as end:
            return 0 if end.value else 1


if __name__ == "__main__":
    sys.exit(main())
