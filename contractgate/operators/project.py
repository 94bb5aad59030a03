"""Typed projection: cast every contracted column to its declared type.

One ``withColumns`` over the present contracted columns; columns the contract
does not know pass through untyped and keep their position. Unparseable
numbers, dates and booleans become null; a non-whole value in an integer column
fails the job (a lossy cast never passes in silence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce as cz
from .contract import ColumnSpec, Contract


def typed_sql(spec: ColumnSpec, dt: T.DataType) -> str:
    c = cz.ident(spec.name)
    if spec.type == "integer":
        return cz.to_bigint_strict(c, dt, spec.name)
    if spec.type == "float":
        return cz.to_number(c, dt)
    if spec.type == "date":
        return f"CAST({cz.to_timestamp(c, dt)} AS DATE)"
    if spec.type == "timestamp":
        return cz.to_timestamp(c, dt)
    if spec.type == "boolean":
        return cz.to_boolean(c, dt)
    return f"CAST({c} AS STRING)"


def typed_column(spec: ColumnSpec, dt: T.DataType) -> Column:
    return F.expr(typed_sql(spec, dt))


def apply_contract_types(df: DataFrame, contract: Contract) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    replacements = {
        spec.name: typed_column(spec, types[spec.name]) for spec in contract.columns if spec.name in types
    }
    return df.withColumns(replacements) if replacements else df


def coercion_exprs(df: DataFrame, contract: Contract, prefix: str = "") -> list[Column]:
    """One counter per contracted column present in ``df``: values present in
    the input that typing turns into null (silent coercions)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for spec in contract.columns:
        if spec.name not in types:
            continue
        dt = types[spec.name]
        c = cz.ident(spec.name)
        typed = cz.to_number(c, dt) if spec.type in ("integer", "float") else typed_sql(spec, dt)
        out.append(F.expr(f"count_if({cz.present(c, dt)} AND ({typed}) IS NULL)").alias(prefix + spec.name))
    return out


def coercion_counts(df: DataFrame, contract: Contract, batch: list[str] | None = None) -> DataFrame:
    """Silent coercions per contracted column, in one aggregate (per batch)."""
    aggs = coercion_exprs(df, contract) or [F.count(F.lit(1)).alias("row_count")]
    return df.groupBy(*(batch or [])).agg(*aggs)
