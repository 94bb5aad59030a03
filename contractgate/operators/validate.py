"""Validation: every rule of a contract counted per batch in one pass.

Plan shape, for input ``df`` and batch key ``b``:

* rule counters: ``groupBy(b).agg(count(*), count_if(rule_1), ...)`` - one scan,
  partial aggregation map-side, so one row per batch per task is shuffled;
* duplicate keys: ``groupBy(b, pk).count()`` then ``sum(n - 1)`` per batch - a
  separate aggregate, so rule counters are never shuffled with every key; it
  reads only the key columns. Beyond ``KEYS_PER_TASK`` rows the keys are dealt to as
  many tasks as that asks for before they are counted, so a task's hash tables do not
  grow with the size of its file; below, a hot key collapses map-side;
* both are at most one row per batch; they are unioned and re-aggregated (no
  join), then unpivoted into the violation table with
  ``explode(array(struct ...))``. Verdicts and manifests are projections of the
  same one-row-per-batch table.

Only the number of rows is looked up here (of a Parquet scan, its metadata). All
outputs are lazy DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .contract import Contract
from .rules import MSG_DUPLICATE, Rule, compile_rules, key_columns, uniqueness_ordinal

_DUMMY = "__batch"
ROWS = "row_count"
# Counters per aggregate. Wider aggregates exceed whole-stage codegen limits and
# take long to compile; chunks group the rules of whole columns, so with column
# pruning each chunk's scan reads only its own columns.
MAX_COUNTERS_PER_AGGREGATE = 64
# Keys counted by one task (about 250 bytes each in a hash table, of which it holds two).
KEYS_PER_TASK = 500_000

VIOLATION_FIELDS = ["ordinal", "check", "column", "message", "failing_rows"]


def _counter(rule: Rule) -> str:
    return f"__r{rule.ordinal}"


def _whole_counter(rule: Rule) -> str:
    return f"__w{rule.ordinal}"


@dataclass
class Validation:
    """Lazy outputs of one validation plan."""

    contract: Contract
    batch: list[str]
    rules: list[Rule]
    counts: DataFrame  # one row per batch: batch cols, row_count, one counter per rule
    violations: DataFrame  # batch cols, entity, contract_version, ordinal, check, column, message, failing_rows
    verdicts: DataFrame  # batch cols, entity, contract_version, row_count, n_violations, is_valid
    items: list = None  # one SQL struct expression per rule, in report order, over ``counts``

    def manifest(self) -> DataFrame:
        """One row per batch with the report as JSON text (the error manifest)."""
        return manifest(self)


def validate(
    df: DataFrame,
    contract: Contract,
    batch: list[str] | None = None,
    *,
    actual: list[str] | None = None,
    extra_column: str | None = None,
    batches: DataFrame | None = None,
) -> Validation:
    """Build the validation plan of ``df`` against ``contract``.

    ``batch``: columns of ``df`` that identify a batch (a source file, a day);
    none means the whole DataFrame is one batch. ``actual``: column names as
    received (defaults to the columns of ``df`` that are not batch or internal
    columns). ``extra_column``: a column that is non-null when a row had more
    fields than the header. ``batches``: every batch key, including batches with
    no rows (a header-only file); their counts are zero.
    """
    batch = list(batch or [])
    # batch columns are pipeline identifiers, unless the contract names them
    internal = {b for b in batch if b not in contract.names} | ({extra_column} if extra_column else set())
    if actual is None:
        actual = [c for c in df.columns if c not in internal]
    data_schema = T.StructType([f for f in df.schema.fields if f.name not in internal or f.name == extra_column])
    rules = compile_rules(contract, data_schema, actual, extra_column)

    keys = batch if batch else [_DUMMY]
    qkeys = [_q(k) for k in keys]
    kcols = [F.col(k) for k in qkeys]  # quoted: names may contain dots
    src = df if batch else df.withColumn(_DUMMY, F.lit(1))

    counters = [(ROWS, F.count(F.lit(1)))]
    for r in rules:
        if r.fixed:
            continue
        counters.append((_counter(r), F.expr(f"count_if({r.fail_sql})")))
        if r.whole_sql is not None:
            counters.append((_whole_counter(r), F.expr(f"count_if({r.whole_sql})")))
    pk = key_columns(contract, actual)
    names = [n for n, _ in counters] + (["__dups"] if pk is not None else [])

    def padded(frame: DataFrame, own: set) -> DataFrame:
        # align one partial table to all counter names; missing ones are 0
        return frame.selectExpr(*qkeys, *[
            f"CAST({n if n in own else 0} AS BIGINT) AS {n}" for n in names])

    parts = []
    for chunk in _chunks(counters, rules):
        rule_counts = src.groupBy(*kcols).agg(*[e.alias(n) for n, e in chunk])
        parts.append(padded(rule_counts, {n for n, _ in chunk}))
    if pk is not None:
        qpk = [_q(k) for k in pk]
        keyed, tasks = src.selectExpr(*qkeys, *qpk), -(-src.count() // KEYS_PER_TASK)
        if tasks > 1:
            keyed = keyed.repartition(tasks, *kcols, *[F.col(k) for k in qpk])
        dup = (
            keyed.groupBy(*kcols, *[F.col(k) for k in qpk])
            .agg(F.count(F.lit(1)).alias("__n"))
            .where("__n > 1")
            .groupBy(*kcols)
            .agg(F.expr("sum(__n - 1)").alias("__dups"))
        )
        parts.append(padded(dup, {"__dups"}))
    if batches is not None:
        # zero-row batches keep a row (row_count 0); AGG-1
        parts.append(padded(batches.selectExpr(*qkeys).distinct(), set()))
    if len(parts) == 1:
        counts = parts[0]
    else:
        # every part is at most one row per batch: a tiny union + re-aggregate,
        # no join between the counter table and the key table
        union = parts[0]
        for p in parts[1:]:
            union = union.unionByName(p)
        counts = union.groupBy(*kcols).agg(*[F.expr(f"CAST(sum({n}) AS BIGINT)").alias(n) for n in names])

    # rule metadata as SQL text over the one-row-per-batch counter table
    items = []
    for r in rules:
        items.append((r.ordinal, r.check, r.column, r.message, _rule_count_sql(r), r.fixed))
    if pk is not None:
        items.append((uniqueness_ordinal(contract), "uniqueness", ",".join(pk), MSG_DUPLICATE, "__dups", False))
    structs = [
        "named_struct('ordinal', CAST({o} AS BIGINT), 'check', {c}, 'column', {col}, 'message', {m}, "
        "'failing_rows', CAST({n} AS BIGINT), 'fires', {f})".format(
            o=o, c=_lit(c), col=_lit(col) if col is not None else "CAST(NULL AS STRING)", m=_lit(m), n=n,
            f="true" if fixed else f"({n}) > 0")
        for o, c, col, m, n, fixed in items
    ]
    fires = [("1" if fixed else f"CASE WHEN ({n}) > 0 THEN 1 ELSE 0 END") for *_, n, fixed in items]
    n_violations = "CAST(" + (" + ".join(fires) if fires else "0") + " AS BIGINT)"
    head = [*[_q(b) for b in batch], f"{_lit(contract.entity)} AS entity", f"{_lit(contract.version)} AS contract_version"]

    verdicts = counts.selectExpr(
        *head, f"CAST({ROWS} AS BIGINT) AS {ROWS}", f"{n_violations} AS n_violations", f"{n_violations} = 0 AS is_valid")

    if structs:
        violations = (
            counts.selectExpr(*[_q(b) for b in batch], "explode(array(" + ", ".join(structs) + ")) AS v")
            .where("v.fires")
            .selectExpr(*head, *[f"v.{f} AS {f}" for f in VIOLATION_FIELDS])
        )
    else:
        violations = counts.where("false").selectExpr(
            *head, "CAST(NULL AS BIGINT) AS ordinal", "CAST(NULL AS STRING) AS check",
            "CAST(NULL AS STRING) AS column", "CAST(NULL AS STRING) AS message", "CAST(NULL AS BIGINT) AS failing_rows")
    return Validation(contract, batch, rules, counts, violations, verdicts, structs)


def _chunks(counters: list, rules: list[Rule]) -> list[list]:
    """Split counters into chunks of at most MAX_COUNTERS_PER_AGGREGATE,
    keeping the counters of one column together."""
    if len(counters) <= MAX_COUNTERS_PER_AGGREGATE:
        return [counters]
    column_of = {}
    for r in rules:
        if not r.fixed:
            column_of[_counter(r)] = r.column
            column_of[_whole_counter(r)] = r.column
    chunks, current, last_col = [], [], object()
    for name, expr in counters:
        col = column_of.get(name)
        if len(current) >= MAX_COUNTERS_PER_AGGREGATE and col != last_col:
            chunks.append(current)
            current = []
        current.append((name, expr))
        last_col = col
    if current:
        chunks.append(current)
    return chunks


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rule_count_sql(rule: Rule) -> str:
    if rule.fixed:
        return "0"
    n = _counter(rule)
    if rule.whole_sql is not None:
        # integer: wholeness is only counted when everything parses
        return f"CASE WHEN {n} > 0 THEN {n} ELSE {_whole_counter(rule)} END"
    return n


def manifest(v: Validation) -> DataFrame:
    """Error manifest per batch: ``{entity, contract_version, row_count, is_valid,
    violations: [{check, column, message, failing_rows}]}`` as JSON text, in
    report order. A projection of the one-row-per-batch counter table: the
    violation list of a batch is bounded by the number of rules."""
    arr = "array(" + ", ".join(v.items) + ")" if v.items else \
        "CAST(array() AS ARRAY<STRUCT<ordinal: BIGINT, check: STRING, column: STRING, message: STRING, " \
        "failing_rows: BIGINT, fires: BOOLEAN>>)"
    fired = f"filter({arr}, x -> x.fires)"
    listed = (f"transform({fired}, x -> named_struct('check', x.check, 'column', x.column, "
              "'message', x.message, 'failing_rows', x.failing_rows))")
    n = f"CAST(size({fired}) AS BIGINT)"
    ent, ver = _lit(v.contract.entity), _lit(v.contract.version)
    doc = (f"named_struct('entity', {ent}, 'contract_version', {ver}, '{ROWS}', CAST({ROWS} AS BIGINT), "
           f"'is_valid', {n} = 0, 'violations', {listed})")
    return v.counts.selectExpr(
        *[_q(b) for b in v.batch], f"{ent} AS entity", f"{ver} AS contract_version",
        f"CAST({ROWS} AS BIGINT) AS {ROWS}", f"{n} = 0 AS is_valid", f"{n} AS n_violations",
        f"to_json({doc}, map('ignoreNullFields', 'false')) AS manifest_json",
    )


def empty_batch_manifest(contract: Contract, rules: list[Rule]) -> dict:
    """The manifest of a batch with no rows: only the fixed (schema) rules can
    fire. Same fields and JSON layout as ``manifest``."""
    import json

    fired = [r for r in rules if r.fixed]
    doc = {
        "entity": contract.entity, "contract_version": contract.version, ROWS: 0, "is_valid": not fired,
        "violations": [{"check": r.check, "column": r.column, "message": r.message, "failing_rows": 0} for r in fired],
    }
    return {
        "entity": contract.entity, "contract_version": contract.version, ROWS: 0, "is_valid": not fired,
        "n_violations": len(fired), "manifest_json": json.dumps(doc, separators=(",", ":"), ensure_ascii=False),
    }


def failing_rows(df: DataFrame, contract: Contract, ordinal: int, actual: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` that break the column rule with ``ordinal``."""
    rules = compile_rules(contract, df.schema, actual)
    for r in rules:
        if r.ordinal == ordinal and not r.fixed:
            cond = r.fail_sql if r.whole_sql is None else f"({r.fail_sql}) OR ({r.whole_sql})"
            return df.where(F.expr(cond))
    raise KeyError(f"no row-level rule with ordinal {ordinal}")
