"""Compile a contract into rule expressions over one DataFrame schema.

Each rule is a per-row failure predicate; validation counts them all inside
one aggregate (see ``validate.py``). Report order is fixed by ``ordinal``:

* 1 missing columns, 2 unexpected columns, 3 rows with more fields than the
  header (CSV sources only);
* contract column ``i`` (0-based, contract order): ``100 * (i + 1) + k`` with
  k = 1 nullability, 2 type, 3 min, 4 max, 5 allowed, 6 pattern;
* uniqueness: ``100 * (number of contract columns + 1)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce as cz
from ..functions.patterns import java_pattern
from .contract import Contract, ColumnSpec

# --- fixed values ------------------------------------------------------------
SLOT_NULL, SLOT_TYPE, SLOT_MIN, SLOT_MAX, SLOT_ALLOWED, SLOT_PATTERN = 1, 2, 3, 4, 5, 6
ORD_MISSING, ORD_UNEXPECTED, ORD_EXTRA_FIELDS = 1, 2, 3
MSG_NULL = "nulls in non-nullable column"
MSG_DUPLICATE = "duplicate primary keys"
MSG_EXTRA_FIELDS = "rows with more fields than the header"
MSG_MISSING = "missing columns: {}"
MSG_UNEXPECTED = "unexpected columns: {}"
MSG_TYPE = "values not parseable as {}"
MSG_MIN = "values below min {}"
MSG_MAX = "values above max {}"
MSG_ALLOWED = "values outside allowed set {}"
MSG_PATTERN = "values not matching {}"
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    ordinal: int
    check: str
    column: str | None
    message: str
    fail_sql: str | None = None  # per-row predicate (Spark SQL); None for a fixed rule
    whole_sql: str | None = None  # integer rule: second counter (non-whole values)

    @property
    def fixed(self) -> bool:
        return self.fail_sql is None

    @property
    def fail(self) -> Column | None:
        return None if self.fail_sql is None else F.expr(self.fail_sql)

    @property
    def fail_whole(self) -> Column | None:
        return None if self.whole_sql is None else F.expr(self.whole_sql)


def column_ordinal(index: int, slot: int) -> int:
    return 100 * (index + 1) + slot


def uniqueness_ordinal(contract: Contract) -> int:
    return 100 * (len(contract.columns) + 1)


def schema_rules(contract: Contract, actual: list[str]) -> list[Rule]:
    """Fixed schema rules for one set of received column names."""
    rules = []
    expected = set(contract.names)
    missing = sorted(expected - set(actual))
    if missing:
        rules.append(Rule(ORD_MISSING, "schema", None, MSG_MISSING.format(missing)))
    unexpected = sorted(set(actual) - expected)
    if unexpected:
        rules.append(Rule(ORD_UNEXPECTED, "schema", None, MSG_UNEXPECTED.format(unexpected)))
    return rules


def column_rules(spec: ColumnSpec, index: int, dt: T.DataType) -> list[Rule]:
    c = cz.ident(spec.name)
    has = cz.present(c, dt)
    out: list[Rule] = []

    def add(slot, check, message, fail, whole=None):
        out.append(Rule(column_ordinal(index, slot), check, spec.name, message, fail, whole))

    if not spec.nullable:
        add(SLOT_NULL, "nullability", MSG_NULL, cz.is_missing(c, dt))

    type_msg = MSG_TYPE.format(spec.type)
    if spec.type in ("integer", "float"):
        num = cz.to_number(c, dt)
        bad = f"{has} AND {num} IS NULL"
        if spec.type == "integer":
            add(SLOT_TYPE, "type", type_msg, bad, f"{has} AND {num} IS NOT NULL AND {cz.not_whole(num)}")
        else:
            add(SLOT_TYPE, "type", type_msg, bad)
    elif spec.type in ("date", "timestamp"):
        add(SLOT_TYPE, "type", type_msg, f"{has} AND NOT {cz.datetime_parses(c, dt)}")
    elif spec.type == "boolean":
        add(SLOT_TYPE, "type", type_msg, f"{has} AND NOT {cz.boolean_token_ok(c, dt)}")

    if spec.has_min or spec.has_max:
        num = cz.to_number(c, dt)
        if spec.has_min:
            add(SLOT_MIN, "domain", MSG_MIN.format(spec.min), f"{has} AND {num} < {cz.num_lit(spec.min)}")
        if spec.has_max:
            add(SLOT_MAX, "domain", MSG_MAX.format(spec.max), f"{has} AND {num} > {cz.num_lit(spec.max)}")

    if spec.allowed is not None:
        members = sorted(set(spec.allowed), key=lambda v: (str(type(v)), v))
        try:
            shown = sorted(set(spec.allowed))
        except TypeError:
            shown = members
        text_members = [v for v in members if isinstance(v, str)]
        text = cz.python_text(c, dt)
        inside = cz._in(text, text_members) if text_members else "false"
        add(SLOT_ALLOWED, "domain", MSG_ALLOWED.format(shown), f"{has} AND NOT {inside}")

    if spec.pattern is not None:
        text = cz.python_text(c, dt)
        add(SLOT_PATTERN, "pattern", MSG_PATTERN.format(spec.pattern),
            f"{has} AND NOT ({text} RLIKE {cz.lit(java_pattern(spec.pattern))})")
    return out


def compile_rules(contract: Contract, schema: T.StructType, actual: list[str] | None = None,
                  extra_column: str | None = None) -> list[Rule]:
    """All rules for data with ``schema``. ``actual`` are the column names as
    received (defaults to the schema's names); column rules run only for
    contracted columns that are present."""
    types = {f.name: f.dataType for f in schema.fields}
    received = list(actual) if actual is not None else [f.name for f in schema.fields]
    rules = schema_rules(contract, received)
    if extra_column is not None:
        rules.append(Rule(ORD_EXTRA_FIELDS, "schema", None, MSG_EXTRA_FIELDS,
                          f"{cz.ident(extra_column)} IS NOT NULL"))
    present_names = set(received)
    for i, spec in enumerate(contract.columns):
        if spec.name in present_names and spec.name in types:
            rules.extend(column_rules(spec, i, types[spec.name]))
    return rules


def key_columns(contract: Contract, actual: list[str]) -> list[str] | None:
    """Primary key columns, or None when the key is empty or not all present."""
    pk = list(contract.primary_key)
    if pk and all(k in actual for k in pk):
        return pk
    return None
