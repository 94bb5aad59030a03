"""Reconciliation: whether what was landed is what was received, batch by batch.

Each row has two 64-bit hashes over its columns (nulls marked, so that a value
that moved to another column shows). A batch's digest is the number of its rows
and the exact sums of their hashes: no order matters, a lost, doubled or changed
row changes it. Received rows count plus, landed rows minus, so both sides meet
in one aggregation with partial sums, one row per batch and task is shuffled,
and batches that exist on one side only are there too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ReconciliationError(RuntimeError):
    """What was written is not what was to be landed; nothing was published."""


def row_hashes(df: DataFrame, columns: list[str]) -> list[Column]:
    parts = []
    for name in sorted(columns):
        column = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, T.MapType):  # maps have no hash
            column = F.array_sort(F.map_entries(column))
        parts += [column.isNull(), column]
    return [F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)") for seed in (0, 1)]


def reconciliation(received: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, received_rows, landed_rows, matches: one row per batch of either
    side, compared over all columns of ``received`` but ``keys``."""
    columns = [c for c in received.columns if c not in keys]

    def side(df: DataFrame, sign: int) -> DataFrame:
        first, second = row_hashes(df, columns)
        return df.select(*[F.col(f"`{k}`") for k in keys], F.lit(sign).alias("__sign"), (first * sign).alias("__first"), (second * sign).alias("__second"))

    def rows(sign: int) -> Column:
        return F.count(F.when(F.col("__sign") == sign, 1))

    both = side(received, 1).unionByName(side(landed, -1))
    same = (F.sum("__sign") == 0) & (F.sum("__first") == 0) & (F.sum("__second") == 0)
    return both.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(rows(1).alias("received_rows"), rows(-1).alias("landed_rows"), same.alias("matches"))


def check_reconciled(received: DataFrame, landed: DataFrame, keys: list[str]) -> None:
    """Raise if any batch differs; the driver reads one count and a few examples."""
    wrong = reconciliation(received, landed, keys).where("NOT matches")
    examples = wrong.limit(5).collect()
    if examples:
        raise ReconciliationError(f"{wrong.count()} batches differ from what was received, such as {[r.asDict() for r in examples]}")
