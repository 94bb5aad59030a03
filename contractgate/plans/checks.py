"""Contract checks over the driver's tables: the registered queries.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables. Dirty values are injected into whole columns (the tables have no nulls
and no malformed text); no rows are dropped or sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.route import route
from ..operators.validate import validate
from .tables import table, tpch_contract


def violations_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full violation report of ``lineitem``: one batch."""
    v = validate(table(spark, sf_dir, "lineitem"), tpch_contract("lineitem"))
    return v.violations


def violations_lineitem_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violation report with one batch per ship year."""
    df = table(spark, sf_dir, "lineitem").withColumn("batch", F.date_format("l_shipdate", "yyyy"))
    return validate(df, tpch_contract("lineitem"), ["batch"]).violations


def _orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("batch", F.date_format("o_orderdate", "yyyy"))


def violations_orders_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nullability: the '4-NOT SPECIFIED' priority read as a missing value."""
    df = table(spark, sf_dir, "orders")
    df = df.withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")))
    return validate(df, tpch_contract("orders")).violations


def violations_orders_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date type rule over text dates; an impossible day every 101st key."""
    df = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 101 == 0, F.lit("2020-02-30")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return validate(df.withColumn("o_orderdate", text), tpch_contract("orders")).violations


def schema_missing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch without a contracted column: schema violation, other rules go on."""
    df = table(spark, sf_dir, "orders").drop("o_orderpriority")
    return validate(df, tpch_contract("orders")).violations


def schema_unexpected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with a column the contract does not know: rejected."""
    df = table(spark, sf_dir, "orders").withColumn("o_clerk", F.format_string("Clerk#%09d", F.col("o_custkey")))
    return validate(df, tpch_contract("orders")).violations


def verdict_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One verdict per yearly batch of orders."""
    return validate(_orders_by_year(spark, sf_dir), tpch_contract("orders"), ["batch"]).verdicts


def manifest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error manifest (JSON) per yearly batch of orders."""
    return validate(_orders_by_year(spark, sf_dir), tpch_contract("orders"), ["batch"]).manifest()


def _routed_orders(spark: SparkSession, sf_dir: str):
    df = _orders_by_year(spark, sf_dir)
    v = validate(df, tpch_contract("orders"), ["batch"])
    return route(df, v.verdicts, ["batch"])


def accepted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the batches that pass."""
    return _routed_orders(spark, sf_dir)[0]


def rejected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the batches that are quarantined; with the accepted rows they
    add up to the input."""
    return _routed_orders(spark, sf_dir)[1]


def violations_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum and pattern rules on customers."""
    return validate(table(spark, sf_dir, "customer"), tpch_contract("customer")).violations


def violations_events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer wholeness, maximum, allowed set and pattern; one batch per day."""
    df = table(spark, sf_dir, "events").withColumn("batch", F.date_format("ts", "yyyy-MM-dd"))
    return validate(df, tpch_contract("events"), ["batch"]).violations


def violations_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Float type rule over every whole text, plus allowed set and pattern."""
    return validate(table(spark, sf_dir, "documents"), tpch_contract("documents")).violations


def violations_labels_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean type rule over text flags: 'TRUE' and 'yes' are not tokens."""
    df = table(spark, sf_dir, "labels")
    text = (F.when(F.col("doc_id") % 7 == 0, F.lit("TRUE"))
            .when(F.col("doc_id") % 11 == 0, F.lit("yes"))
            .otherwise(F.col("quality").cast("string")))
    return validate(df.withColumn("quality", text), tpch_contract("labels")).violations


def violations_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern, minimum and maximum rules on parts."""
    return validate(table(spark, sf_dir, "part"), tpch_contract("part")).violations


def violations_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative balances on suppliers."""
    return validate(table(spark, sf_dir, "supplier"), tpch_contract("supplier")).violations


def violations_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed speakers and turn range; two-column key (conv_id, turn)."""
    return validate(table(spark, sf_dir, "conversations"), tpch_contract("conversations")).violations


def violations_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL scheme and a pattern over every whole HTML document."""
    return validate(table(spark, sf_dir, "pages"), tpch_contract("pages")).violations


REGISTERED = [
    "violations_lineitem",
    "violations_lineitem_by_year",
    "violations_orders_nulls",
    "violations_orders_text_dates",
    "schema_missing_orders",
    "schema_unexpected_orders",
    "verdict_orders",
    "manifest_orders",
    "accepted_orders",
    "rejected_orders",
    "violations_customer",
    "violations_events_by_day",
    "violations_documents",
    "violations_labels_text",
    "violations_part",
    "violations_supplier",
    "violations_conversations",
    "violations_pages",
]
