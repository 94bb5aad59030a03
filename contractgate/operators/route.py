"""Accept/reject routing: a batch lands whole or is quarantined whole.

Two forms:

* ``route``: for any batch key. The verdicts (one small row per batch) are
  written out once and measured; below a bound in bytes they are broadcast, so
  the data is never shuffled by batch; beyond it an ordinary join takes over,
  whose hot keys adaptive execution splits.
* file batches: when the verdicts are already known on the driver (the ingest
  job), the accepted and rejected files are simply scanned separately (see
  ``plans.ingest``): no join at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_dir

# A table of batches is broadcast up to this size.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
_ROW_OVERHEAD = 64  # of a row in a hash table


def key_bytes(keys: DataFrame) -> int:
    """Size of a table of batch keys in memory: its text and a fixed overhead per row."""
    text = F.octet_length(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in keys.columns]))
    return keys.agg(F.coalesce(F.sum(text + _ROW_OVERHEAD), F.lit(0)).alias("n")).first().n


def maybe_broadcast(keys: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``keys`` marked for broadcasting if its measured size allows it."""
    return F.broadcast(keys) if key_bytes(keys) <= max_bytes else keys


def batch_join(df: DataFrame, keys: DataFrame, batch: list[str], how: str = "left_semi") -> DataFrame:
    """Join on the batch columns with null-safe equality: a batch whose key is
    null (e.g. rows without a date) is routed like any other, never dropped.
    Both sides get uniquely named key columns, so a verdict table derived from
    ``df`` itself resolves without ambiguity. Other columns of ``keys`` are kept
    by an inner join."""
    left = df.withColumns({f"__l{i}": F.col(f"`{b}`") for i, b in enumerate(batch)})
    right = keys.withColumnsRenamed({b: f"__k{i}" for i, b in enumerate(batch)})
    cond = None
    for i in range(len(batch)):
        c = F.col(f"__l{i}").eqNullSafe(F.col(f"__k{i}"))
        cond = c if cond is None else cond & c
    return left.join(right, on=cond, how=how).drop(*[f"__{s}{i}" for s in "lk" for i in range(len(batch))])


def settled(verdicts: DataFrame, name: str = "verdicts") -> DataFrame:
    """The verdicts as a written table: validation runs once for both routes."""
    spark = verdicts.sparkSession
    path = work_dir(spark, name, fresh=True)
    verdicts.write.parquet(path)
    return spark.read.schema(verdicts.schema).parquet(path)


def route(df: DataFrame, verdicts: DataFrame, batch: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (accepted, rejected) rows by the verdict of its batch.

    The two sides add up to the input: a batch is either valid or not.
    """
    verdicts = settled(verdicts.select(*batch, "is_valid"))
    valid = maybe_broadcast(verdicts.where("is_valid").select(*batch))
    return batch_join(df, valid, batch, "left_semi"), batch_join(df, valid, batch, "left_anti")
