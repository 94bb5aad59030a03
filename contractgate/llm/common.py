"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from ..sources.files import hadoop_fs


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers of the session (once), as
    ``--py-files`` would, so that they need not have it installed."""
    context = spark.sparkContext
    if any(p.startswith(f"{_PACKAGE.name}-shipped") for p in context._python_includes):
        return
    folder = Path(tempfile.mkdtemp(prefix="ship-"))
    archive = folder / f"{_PACKAGE.name}-shipped.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(_PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage so that a lost executor costs a re-read, not a re-run."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm/{name}", fresh=True)
    # the shuffle files of this write alone go when it is done, and the session's setting is put back
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more."""
    for df in written:
        path, fs = hadoop_fs(df.sparkSession, df.scratch)
        fs.delete(path, True)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a row number ``__row`` (increasing, not gapless), written
    out, so that every later read sees the same numbers."""
    return materialise(docs.withColumn("__row", F.monotonically_increasing_id()), name)


# A side of a join with at most this many (narrow) rows is broadcast.
BROADCAST_ROWS = 200_000


def if_small(df: DataFrame) -> DataFrame:
    """``df`` (a written table) marked for broadcasting if its row count allows
    it; otherwise for a shuffled join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("merge")


def crc_fold(id_column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: fold of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % modulus
