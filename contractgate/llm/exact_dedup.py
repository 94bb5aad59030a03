"""Exact dedup by progressive refinement: rows are grouped by length, then by
the hash of a prefix, then by the hash of the whole normalised text; each step
looks only at what shares a group after the step before.

Texts are equal when they are identical without the characters space and
\\x09-\\x0D. Of equal texts the row with the most code points in the original
text stays, then the one with the smallest doc_id (null last), then the first
in the table.

DataFrame functions only. The steps work on one narrow table (lengths and
hashes, written once below the checkpoint folder), never on texts; groups are
counted with partial aggregation, so a text held by a third of all rows is one
row per task before the shuffle, and its members are found by an ordinary join
that adaptive execution splits.

With ``digest_all`` every row's whole-text hash is computed in the first scan,
for callers that want the digest of every row. Without it the first scan reads
lengths and prefixes only, and a second one hashes the texts of rows that
survived both groupings.

Defined cases: null counts as empty; empty texts are equal to each other and
to texts of white space only; repeated rows are copies of each other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, numbered, text_of

WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    for c in WHITE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def exact_dedup(docs: DataFrame, prefix_chars: int = 64, digest_all: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 (null for rows whose text
    had no need of it, unless ``digest_all``), one row per input row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    if digest_all:  # texts are read once
        rows = rows.withColumn("row", F.monotonically_increasing_id())
    else:
        rows = numbered(rows, "documents").withColumnRenamed("__row", "row")
    norm = normalised(F.col("text"))
    digest = F.unhex(F.sha2(F.col("norm"), 256))
    found = rows.select("doc_id", "row", F.length("text").alias("chars"), norm.alias("norm")).select(
        "doc_id", "row", "chars", F.length("norm").alias("length"),
        F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix"),
        *([digest.alias("digest")] if digest_all else []))
    found = materialise(found, "dedup")

    lengths = found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("length")
    by_length = found.join(lengths, "length", "left_semi")
    prefixes = by_length.groupBy("length", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("length", "prefix")
    alike = by_length.join(prefixes, ["length", "prefix"], "left_semi")
    if not digest_all:
        texts = rows.join(alike.select("row"), "row", "left_semi").select("row", norm.alias("norm")).select("row", digest.alias("digest"))
        alike = alike.join(texts, "row")
    first = F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    groups = (alike.groupBy("length", "prefix", "digest")
              .agg(F.count(F.lit(1)).alias("group_size"), F.min(first).alias("first")).where("group_size > 1"))
    if digest_all:
        placed = found.join(groups, ["length", "prefix", "digest"], "left")
    else:
        placed = found.join(alike.join(groups, ["length", "prefix", "digest"], "left").select("row", "digest", "group_size", "first"), "row", "left")
    alone = F.col("first").isNull()
    return placed.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = r"""
    WITH n AS (SELECT doc_id, coalesce(text, '') AS t,
                      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
           CAST(count(*) OVER (PARTITION BY norm) AS BIGINT) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)
"""
