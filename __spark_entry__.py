"""


The Spark side is the library (``contractgate``); the SQL side is written out
by hand, rule by rule, so that it checks the rule compiler instead of
repeating it. Report ordinals follow the rule in ``contractgate/operators/rules.py``:
column i (0-based, contract order) uses 100*(i+1)+k with k = 1 null, 2 type,
3 min, 4 max, 5 allowed, 6 pattern; uniqueness is 100*(columns+1).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from contractgate.plans import checks, zone_checks  # noqa: E402

# the training-data operators are an optional part of the package; where they are there, a failing import is an error
_LLM_IS_THERE = os.path.exists(os.path.join(_HERE, "contractgate", "llm", "registry.py"))
try:
    from contractgate.llm import registry as _llm
except ImportError:
    if _LLM_IS_THERE:
        raise
    _llm = None

try:
    import corpus_pipeline as _pipeline
except ImportError:
    if _LLM_IS_THERE and os.path.exists(os.path.join(_HERE, "corpus_pipeline.py")):
        raise
    _pipeline = None

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return checks.violations_lineitem(spark, FLAGSHIP_SF_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: getattr(checks, name) for name in checks.REGISTERED}
    out.update({name: getattr(zone_checks, name) for name in zone_checks.REGISTERED})
    if _llm is not None:
        out.update(_llm.QUERIES)
    if _pipeline is not None:
        out["pipeline"] = _pipeline.run
    return out


# --------------------------------------------------------------------------
# Oracle SQL (DuckDB). Every aggregate is aliased to the Spark column name.
# --------------------------------------------------------------------------

_LINEITEM_COUNTS = """
    count(*) AS rows_,
    count_if(l_orderkey IS NULL) AS "101", count_if(l_orderkey < 0) AS "103",
    count_if(l_partkey IS NULL) AS "201", count_if(l_partkey < 0) AS "203",
    count_if(l_suppkey IS NULL) AS "301", count_if(l_suppkey < 0) AS "303",
    count_if(l_linenumber IS NULL) AS "401", count_if(l_linenumber < 1) AS "403",
    count_if(l_linenumber > 7) AS "404",
    count_if(l_quantity IS NULL OR isnan(l_quantity)) AS "501", count_if(l_quantity < 1) AS "503",
    count_if(l_quantity > 45) AS "504",
    count_if(l_extendedprice IS NULL OR isnan(l_extendedprice)) AS "601",
    count_if(l_extendedprice < 0) AS "603",
    count_if(l_discount IS NULL OR isnan(l_discount)) AS "701", count_if(l_discount < 0) AS "703",
    count_if(l_discount > 0.09) AS "704",
    count_if(l_tax IS NULL OR isnan(l_tax)) AS "801", count_if(l_tax < 0) AS "803",
    count_if(l_tax > 0.08) AS "804",
    count_if(l_returnflag IS NULL) AS "901", count_if(l_returnflag NOT IN ('A', 'R')) AS "905",
    count_if(l_linestatus IS NULL) AS "1001", count_if(l_linestatus NOT IN ('F', 'O')) AS "1005",
    count_if(l_shipdate IS NULL) AS "1101",
    count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS "1200"
"""

_LINEITEM_META = """
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 'l_orderkey', 'nulls in non-nullable column'),
      (103, 'domain', 'l_orderkey', 'values below min 0'),
      (201, 'nullability', 'l_partkey', 'nulls in non-nullable column'),
      (203, 'domain', 'l_partkey', 'values below min 0'),
      (301, 'nullability', 'l_suppkey', 'nulls in non-nullable column'),
      (303, 'domain', 'l_suppkey', 'values below min 0'),
      (401, 'nullability', 'l_linenumber', 'nulls in non-nullable column'),
      (403, 'domain', 'l_linenumber', 'values below min 1'),
      (404, 'domain', 'l_linenumber', 'values above max 7'),
      (501, 'nullability', 'l_quantity', 'nulls in non-nullable column'),
      (503, 'domain', 'l_quantity', 'values below min 1'),
      (504, 'domain', 'l_quantity', 'values above max 45'),
      (601, 'nullability', 'l_extendedprice', 'nulls in non-nullable column'),
      (603, 'domain', 'l_extendedprice', 'values below min 0'),
      (701, 'nullability', 'l_discount', 'nulls in non-nullable column'),
      (703, 'domain', 'l_discount', 'values below min 0'),
      (704, 'domain', 'l_discount', 'values above max 0.09'),
      (801, 'nullability', 'l_tax', 'nulls in non-nullable column'),
      (803, 'domain', 'l_tax', 'values below min 0'),
      (804, 'domain', 'l_tax', 'values above max 0.08'),
      (901, 'nullability', 'l_returnflag', 'nulls in non-nullable column'),
      (905, 'domain', 'l_returnflag', 'values outside allowed set [''A'', ''R'']'),
      (1001, 'nullability', 'l_linestatus', 'nulls in non-nullable column'),
      (1005, 'domain', 'l_linestatus', 'values outside allowed set [''F'', ''O'']'),
      (1101, 'nullability', 'l_shipdate', 'nulls in non-nullable column'),
      (1200, 'uniqueness', 'l_orderkey,l_linenumber', 'duplicate primary keys'))
"""


def _report(meta: str, counts_cte: str, entity: str, version: str, batch: list[str]) -> str:
    """Unpivot a one-row-per-batch counts CTE and attach rule metadata."""
    keep = ", ".join(batch + ["rows_"])
    sel = "".join(f"u.{b}, " for b in batch)
    return f"""
    WITH {meta}, c AS ({counts_cte}),
    u AS (UNPIVOT c ON COLUMNS(* EXCLUDE ({keep})) INTO NAME ordinal VALUE failing_rows)
    SELECT {sel}'{entity}' AS entity, '{version}' AS contract_version,
           CAST(u.ordinal AS BIGINT) AS ordinal, m."check", m."column", m.message,
           CAST(u.failing_rows AS BIGINT) AS failing_rows
    FROM u JOIN meta m ON CAST(u.ordinal AS BIGINT) = m.ordinal
    WHERE u.failing_rows > 0
    """


_ORDERS_META = """
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 'o_orderkey', 'nulls in non-nullable column'),
      (103, 'domain', 'o_orderkey', 'values below min 0'),
      (201, 'nullability', 'o_custkey', 'nulls in non-nullable column'),
      (203, 'domain', 'o_custkey', 'values below min 0'),
      (301, 'nullability', 'o_orderstatus', 'nulls in non-nullable column'),
      (305, 'domain', 'o_orderstatus', 'values outside allowed set [''F'', ''O'', ''P'']'),
      (401, 'nullability', 'o_totalprice', 'nulls in non-nullable column'),
      (403, 'domain', 'o_totalprice', 'values below min 0'),
      (404, 'domain', 'o_totalprice', 'values above max 499000'),
      (501, 'nullability', 'o_orderdate', 'nulls in non-nullable column'),
      (502, 'type', 'o_orderdate', 'values not parseable as date'),
      (601, 'nullability', 'o_orderpriority', 'nulls in non-nullable column'),
      (700, 'uniqueness', 'o_orderkey', 'duplicate primary keys'))
"""

_ORDERS_COUNTS_BASE = """
    count(*) AS rows_,
    count_if(o_orderkey IS NULL) AS "101", count_if(o_orderkey < 0) AS "103",
    count_if(o_custkey IS NULL) AS "201", count_if(o_custkey < 0) AS "203",
    count_if(o_orderstatus IS NULL) AS "301", count_if(o_orderstatus NOT IN ('F', 'O', 'P')) AS "305",
    count_if(o_totalprice IS NULL OR isnan(o_totalprice)) AS "401", count_if(o_totalprice < 0) AS "403",
    count_if(o_totalprice > 499000) AS "404",
    count_if(o_orderdate IS NULL) AS "501",
    count(*) - count(DISTINCT o_orderkey) AS "700"
"""
_ORDERS_COUNTS = _ORDERS_COUNTS_BASE + ', count_if(o_orderpriority IS NULL) AS "601"'

_ORDERS_BY_YEAR = f"SELECT strftime(o_orderdate, '%Y') AS batch, {_ORDERS_COUNTS} FROM orders GROUP BY 1"

_ORDERS_VALID_YEARS = f"""
    SELECT batch FROM ({_ORDERS_BY_YEAR})
    WHERE "101" + "103" + "201" + "203" + "301" + "305" + "401" + "403" + "404" + "501" + "601" + "700" = 0
"""

_CUSTOMER_META = """
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 'c_custkey', 'nulls in non-nullable column'),
      (103, 'domain', 'c_custkey', 'values below min 0'),
      (201, 'nullability', 'c_name', 'nulls in non-nullable column'),
      (206, 'pattern', 'c_name', 'values not matching ^Customer#[0-9]{8}[1-9]$'),
      (301, 'nullability', 'c_nationkey', 'nulls in non-nullable column'),
      (303, 'domain', 'c_nationkey', 'values below min 0'),
      (304, 'domain', 'c_nationkey', 'values above max 24'),
      (401, 'nullability', 'c_acctbal', 'nulls in non-nullable column'),
      (403, 'domain', 'c_acctbal', 'values below min 0'),
      (501, 'nullability', 'c_mktsegment', 'nulls in non-nullable column'),
      (505, 'domain', 'c_mktsegment', 'values outside allowed set [''AUTOMOBILE'', ''BUILDING'', ''FURNITURE'', ''HOUSEHOLD'', ''MACHINERY'']'),
      (600, 'uniqueness', 'c_custkey', 'duplicate primary keys'))
"""

_CUSTOMER_COUNTS = """
    count(*) AS rows_,
    count_if(c_custkey IS NULL) AS "101", count_if(c_custkey < 0) AS "103",
    count_if(c_name IS NULL) AS "201",
    count_if(NOT regexp_matches(c_name, '^(?:^Customer#[0-9]{8}[1-9]$)')) AS "206",
    count_if(c_nationkey IS NULL) AS "301", count_if(c_nationkey < 0) AS "303", count_if(c_nationkey > 24) AS "304",
    count_if(c_acctbal IS NULL OR isnan(c_acctbal)) AS "401", count_if(c_acctbal < 0) AS "403",
    count_if(c_mktsegment IS NULL) AS "501",
    count_if(c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')) AS "505",
    count(*) - count(DISTINCT c_custkey) AS "600"
"""

_EVENTS_META = r"""
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 'event_id', 'nulls in non-nullable column'),
      (103, 'domain', 'event_id', 'values below min 0'),
      (201, 'nullability', 'ts', 'nulls in non-nullable column'),
      (301, 'nullability', 'user_id', 'nulls in non-nullable column'),
      (303, 'domain', 'user_id', 'values below min 0'),
      (401, 'nullability', 'event_type', 'nulls in non-nullable column'),
      (405, 'domain', 'event_type', 'values outside allowed set [''click'', ''purchase'', ''signup'', ''view'']'),
      (502, 'type', 'value', 'values not parseable as integer'),
      (503, 'domain', 'value', 'values below min 0'),
      (504, 'domain', 'value', 'values above max 400'),
      (606, 'pattern', 'props', 'values not matching ^\{"k": [0-9]\}$'),
      (700, 'uniqueness', 'event_id', 'duplicate primary keys'))
"""

_EVENTS_COUNTS = r"""
    count(*) AS rows_,
    count_if(event_id IS NULL) AS "101", count_if(event_id < 0) AS "103",
    count_if(ts IS NULL) AS "201",
    count_if(user_id IS NULL) AS "301", count_if(user_id < 0) AS "303",
    count_if(event_type IS NULL) AS "401",
    count_if(event_type NOT IN ('click', 'purchase', 'signup', 'view')) AS "405",
    count_if(NOT isnan(value) AND value % 1 <> 0) AS "502",
    count_if(NOT isnan(value) AND value < 0) AS "503", count_if(NOT isnan(value) AND value > 400) AS "504",
    count_if(NOT regexp_matches(props, '^(?:^\{"k": [0-9]\}$)')) AS "606",
    count(*) - count(DISTINCT event_id) AS "700"
"""

_DOCUMENTS_META = """
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 'doc_id', 'nulls in non-nullable column'),
      (103, 'domain', 'doc_id', 'values below min 0'),
      (201, 'nullability', 'text', 'nulls in non-nullable column'),
      (202, 'type', 'text', 'values not parseable as float'),
      (301, 'nullability', 'lang', 'nulls in non-nullable column'),
      (305, 'domain', 'lang', 'values outside allowed set [''de'', ''en'', ''es'', ''fr'']'),
      (401, 'nullability', 'source', 'nulls in non-nullable column'),
      (406, 'pattern', 'source', 'values not matching ^src[0-9]+$'),
      (501, 'nullability', 'n_chars', 'nulls in non-nullable column'),
      (503, 'domain', 'n_chars', 'values below min 1'),
      (600, 'uniqueness', 'doc_id', 'duplicate primary keys'))
"""

_DOCUMENTS_COUNTS = """
    count(*) AS rows_,
    count_if(doc_id IS NULL) AS "101", count_if(doc_id < 0) AS "103",
    count_if(text IS NULL) AS "201", count_if(text IS NOT NULL AND try_cast(text AS DOUBLE) IS NULL) AS "202",
    count_if(lang IS NULL) AS "301", count_if(lang NOT IN ('de', 'en', 'es', 'fr')) AS "305",
    count_if(source IS NULL) AS "401", count_if(NOT regexp_matches(source, '^(?:^src[0-9]+$)')) AS "406",
    count_if(n_chars IS NULL) AS "501", count_if(n_chars < 1) AS "503",
    count(*) - count(DISTINCT doc_id) AS "600"
"""

_LABELS_META = """
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 'doc_id', 'nulls in non-nullable column'),
      (103, 'domain', 'doc_id', 'values below min 0'),
      (201, 'nullability', 'quality', 'nulls in non-nullable column'),
      (202, 'type', 'quality', 'values not parseable as boolean'),
      (301, 'nullability', 'toxic', 'nulls in non-nullable column'),
      (302, 'type', 'toxic', 'values not parseable as boolean'),
      (400, 'uniqueness', 'doc_id', 'duplicate primary keys'))
"""

_LABELS_COUNTS = """
    count(*) AS rows_,
    count_if(doc_id IS NULL) AS "101", count_if(doc_id < 0) AS "103",
    count_if(q IS NULL) AS "201",
    count_if(q NOT IN ('True', 'False', 'true', 'false', '0', '1')) AS "202",
    count_if(toxic IS NULL) AS "301", count_if(toxic NOT IN (0, 1)) AS "302",
    count(*) - count(DISTINCT doc_id) AS "400"
"""


def _schema_row(ordinal: int, message: str) -> str:
    msg = message.replace("'", "''")
    return (f"SELECT 'orders' AS entity, '1.0.0' AS contract_version, CAST({ordinal} AS BIGINT) AS ordinal, "
            f"'schema' AS \"check\", CAST(NULL AS VARCHAR) AS \"column\", '{msg}' AS message, "
            f"CAST(0 AS BIGINT) AS failing_rows")


# orders months (batches of the zone queries) that break any rule of the orders contract
_ORDERS_BAD_MONTHS = """
    SELECT strftime(o_orderdate, '%Y-%m') AS m FROM orders GROUP BY 1
    HAVING count_if(o_orderkey IS NULL OR o_orderkey < 0 OR o_custkey IS NULL OR o_custkey < 0
                    OR o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')
                    OR o_totalprice IS NULL OR isnan(o_totalprice) OR o_totalprice < 0 OR o_totalprice > 499000
                    OR o_orderdate IS NULL OR o_orderpriority IS NULL) > 0
        OR count(*) <> count(DISTINCT o_orderkey)
"""

_ORDERS_LATEST_GOOD_MONTH = f"""
    SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') NOT IN ({_ORDERS_BAD_MONTHS})
"""

_RAW_ORDERS = """
    SELECT *, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, '01' AS day,
           'orders.parquet' AS source_file
    FROM orders
"""


_PART_META = """
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 'p_partkey', 'nulls in non-nullable column'),
      (103, 'domain', 'p_partkey', 'values below min 0'),
      (201, 'nullability', 'p_name', 'nulls in non-nullable column'),
      (301, 'nullability', 'p_brand', 'nulls in non-nullable column'),
      (306, 'pattern', 'p_brand', 'values not matching ^Brand#[0-9]{2}$'),
      (401, 'nullability', 'p_type', 'nulls in non-nullable column'),
      (501, 'nullability', 'p_size', 'nulls in non-nullable column'),
      (503, 'domain', 'p_size', 'values below min 1'),
      (504, 'domain', 'p_size', 'values above max 40'),
      (601, 'nullability', 'p_retailprice', 'nulls in non-nullable column'),
      (603, 'domain', 'p_retailprice', 'values below min 0'),
      (604, 'domain', 'p_retailprice', 'values above max 990'),
      (700, 'uniqueness', 'p_partkey', 'duplicate primary keys'))
"""

_PART_COUNTS = """
    count(*) AS rows_,
    count_if(p_partkey IS NULL) AS "101", count_if(p_partkey < 0) AS "103",
    count_if(p_name IS NULL) AS "201",
    count_if(p_brand IS NULL) AS "301", count_if(NOT regexp_matches(p_brand, '^(?:^Brand#[0-9]{2}$)')) AS "306",
    count_if(p_type IS NULL) AS "401",
    count_if(p_size IS NULL) AS "501", count_if(p_size < 1) AS "503", count_if(p_size > 40) AS "504",
    count_if(p_retailprice IS NULL OR isnan(p_retailprice)) AS "601", count_if(p_retailprice < 0) AS "603",
    count_if(p_retailprice > 990) AS "604",
    count(*) - count(DISTINCT p_partkey) AS "700"
"""

_SUPPLIER_META = """
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 's_suppkey', 'nulls in non-nullable column'),
      (103, 'domain', 's_suppkey', 'values below min 0'),
      (201, 'nullability', 's_name', 'nulls in non-nullable column'),
      (206, 'pattern', 's_name', 'values not matching ^Supplier#[0-9]{9}$'),
      (301, 'nullability', 's_nationkey', 'nulls in non-nullable column'),
      (303, 'domain', 's_nationkey', 'values below min 0'),
      (304, 'domain', 's_nationkey', 'values above max 24'),
      (401, 'nullability', 's_acctbal', 'nulls in non-nullable column'),
      (403, 'domain', 's_acctbal', 'values below min 0'),
      (500, 'uniqueness', 's_suppkey', 'duplicate primary keys'))
"""

_SUPPLIER_COUNTS = """
    count(*) AS rows_,
    count_if(s_suppkey IS NULL) AS "101", count_if(s_suppkey < 0) AS "103",
    count_if(s_name IS NULL) AS "201", count_if(NOT regexp_matches(s_name, '^(?:^Supplier#[0-9]{9}$)')) AS "206",
    count_if(s_nationkey IS NULL) AS "301", count_if(s_nationkey < 0) AS "303", count_if(s_nationkey > 24) AS "304",
    count_if(s_acctbal IS NULL OR isnan(s_acctbal)) AS "401", count_if(s_acctbal < 0) AS "403",
    count(*) - count(DISTINCT s_suppkey) AS "500"
"""

_CONVERSATIONS_META = """
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 'conv_id', 'nulls in non-nullable column'),
      (103, 'domain', 'conv_id', 'values below min 0'),
      (201, 'nullability', 'turn', 'nulls in non-nullable column'),
      (203, 'domain', 'turn', 'values below min 0'),
      (204, 'domain', 'turn', 'values above max 5'),
      (301, 'nullability', 'role', 'nulls in non-nullable column'),
      (305, 'domain', 'role', 'values outside allowed set [''assistant'', ''user'']'),
      (401, 'nullability', 'text', 'nulls in non-nullable column'),
      (500, 'uniqueness', 'conv_id,turn', 'duplicate primary keys'))
"""

_CONVERSATIONS_COUNTS = """
    count(*) AS rows_,
    count_if(conv_id IS NULL) AS "101", count_if(conv_id < 0) AS "103",
    count_if(turn IS NULL) AS "201", count_if(turn < 0) AS "203", count_if(turn > 5) AS "204",
    count_if(role IS NULL) AS "301", count_if(role NOT IN ('user', 'assistant')) AS "305",
    count_if(text IS NULL) AS "401",
    count(*) - count(DISTINCT (conv_id, turn)) AS "500"
"""

_PAGES_META = r"""
    meta(ordinal, "check", "column", message) AS (VALUES
      (101, 'nullability', 'page_id', 'nulls in non-nullable column'),
      (103, 'domain', 'page_id', 'values below min 0'),
      (201, 'nullability', 'url', 'nulls in non-nullable column'),
      (206, 'pattern', 'url', 'values not matching ^https://'),
      (301, 'nullability', 'html', 'nulls in non-nullable column'),
      (306, 'pattern', 'html', 'values not matching ^<!DOCTYPE html><html[^>]*>.*</html>\s*$'),
      (400, 'uniqueness', 'page_id', 'duplicate primary keys'))
"""

_PAGES_COUNTS = r"""
    count(*) AS rows_,
    count_if(page_id IS NULL) AS "101", count_if(page_id < 0) AS "103",
    count_if(url IS NULL) AS "201", count_if(NOT regexp_matches(url, '^(?:^https://)')) AS "206",
    count_if(html IS NULL) AS "301",
    count_if(NOT regexp_matches(html, '^(?:^<!DOCTYPE html><html[^>]*>.*</html>\s*$)')) AS "306",
    count(*) - count(DISTINCT page_id) AS "400"
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["violations_lineitem"] = _report(
        _LINEITEM_META, f"SELECT {_LINEITEM_COUNTS} FROM lineitem", "lineitem", "1.0.0", [])
    q["violations_lineitem_by_year"] = _report(
        _LINEITEM_META,
        f"SELECT strftime(l_shipdate, '%Y') AS batch, {_LINEITEM_COUNTS} FROM lineitem GROUP BY 1",
        "lineitem", "1.0.0", ["batch"])
    q["violations_orders_nulls"] = _report(
        _ORDERS_META,
        f"""SELECT {_ORDERS_COUNTS} FROM (SELECT * REPLACE (nullif(o_orderpriority, '4-NOT SPECIFIED')
            AS o_orderpriority) FROM orders)""",
        "orders", "1.0.0", [])
    q["violations_orders_text_dates"] = _report(
        _ORDERS_META,
        f"""SELECT {_ORDERS_COUNTS},
                   count_if(o_orderdate IS NOT NULL AND try_cast(o_orderdate AS DATE) IS NULL) AS "502"
            FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 101 = 0 THEN '2020-02-30'
                                         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate)
                  FROM orders)""",
        "orders", "1.0.0", [])
    q["schema_missing_orders"] = (
        _report(_ORDERS_META, f"SELECT {_ORDERS_COUNTS_BASE} FROM orders", "orders", "1.0.0", [])
        + " UNION ALL " + _schema_row(1, "missing columns: ['o_orderpriority']"))
    q["schema_unexpected_orders"] = (
        _report(_ORDERS_META, f"SELECT {_ORDERS_COUNTS} FROM orders", "orders", "1.0.0", [])
        + " UNION ALL " + _schema_row(2, "unexpected columns: ['o_clerk']"))
    q["verdict_orders"] = f"""
        WITH {_ORDERS_META}, c AS ({_ORDERS_BY_YEAR}),
        u AS (UNPIVOT c ON COLUMNS(* EXCLUDE (batch, rows_)) INTO NAME ordinal VALUE failing_rows),
        v AS (SELECT batch, count_if(failing_rows > 0) AS n FROM u GROUP BY batch)
        SELECT c.batch, 'orders' AS entity, '1.0.0' AS contract_version,
               CAST(c.rows_ AS BIGINT) AS row_count, CAST(v.n AS BIGINT) AS n_violations,
               v.n = 0 AS is_valid
        FROM c JOIN v ON c.batch = v.batch
    """
    q["manifest_orders"] = f"""
        WITH {_ORDERS_META}, c AS ({_ORDERS_BY_YEAR}),
        u AS (UNPIVOT c ON COLUMNS(* EXCLUDE (batch, rows_)) INTO NAME ordinal VALUE failing_rows),
        f AS (SELECT u.batch, CAST(u.ordinal AS BIGINT) AS ordinal, m."check", m."column", m.message,
                     CAST(u.failing_rows AS BIGINT) AS failing_rows
              FROM u JOIN meta m ON CAST(u.ordinal AS BIGINT) = m.ordinal WHERE u.failing_rows > 0),
        l AS (SELECT batch, count(*) AS n,
                     string_agg('{{"check":"' || "check" || '","column":'
                                || coalesce('"' || "column" || '"', 'null')
                                || ',"message":"' || message || '","failing_rows":' || failing_rows || '}}',
                                ',' ORDER BY ordinal) AS items
              FROM f GROUP BY batch)
        SELECT c.batch, 'orders' AS entity, '1.0.0' AS contract_version, CAST(c.rows_ AS BIGINT) AS row_count,
               coalesce(l.n, 0) = 0 AS is_valid, CAST(coalesce(l.n, 0) AS BIGINT) AS n_violations,
               '{{"entity":"orders","contract_version":"1.0.0","row_count":' || c.rows_
               || ',"is_valid":' || CASE WHEN coalesce(l.n, 0) = 0 THEN 'true' ELSE 'false' END
               || ',"violations":[' || coalesce(l.items, '') || ']}}' AS manifest_json
        FROM c LEFT JOIN l ON c.batch = l.batch
    """
    q["accepted_orders"] = f"""
        SELECT *, strftime(o_orderdate, '%Y') AS batch FROM orders
        WHERE strftime(o_orderdate, '%Y') IN ({_ORDERS_VALID_YEARS})
    """
    q["rejected_orders"] = f"""
        SELECT *, strftime(o_orderdate, '%Y') AS batch FROM orders
        WHERE strftime(o_orderdate, '%Y') NOT IN ({_ORDERS_VALID_YEARS})
    """
    q["violations_customer"] = _report(
        _CUSTOMER_META, f"SELECT {_CUSTOMER_COUNTS} FROM customer", "customer", "1.0.0", [])
    q["violations_events_by_day"] = _report(
        _EVENTS_META, f"SELECT strftime(ts, '%Y-%m-%d') AS batch, {_EVENTS_COUNTS} FROM events GROUP BY 1",
        "events", "2.1.0", ["batch"])
    q["violations_documents"] = _report(
        _DOCUMENTS_META, f"SELECT {_DOCUMENTS_COUNTS} FROM documents", "documents", "1.0.0", [])
    q["violations_labels_text"] = _report(
        _LABELS_META,
        f"""SELECT {_LABELS_COUNTS} FROM (
              SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'TRUE' WHEN doc_id % 11 = 0 THEN 'yes'
                             ELSE CAST(quality AS VARCHAR) END AS q FROM labels)""",
        "labels", "1.0.0", [])
    q["staged_orders"] = """
        SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
               o_orderstatus, o_totalprice,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
               o_orderpriority
        FROM orders
    """
    q["coercions_orders"] = """
        SELECT CAST(0 AS BIGINT) AS o_orderkey, CAST(count_if(o_orderkey % 97 = 0) AS BIGINT) AS o_custkey,
               CAST(0 AS BIGINT) AS o_orderstatus, CAST(0 AS BIGINT) AS o_totalprice,
               CAST(count_if(o_orderkey % 101 = 0) AS BIGINT) AS o_orderdate, CAST(0 AS BIGINT) AS o_orderpriority
        FROM orders
    """
    q["raw_orders_month"] = f"""
        SELECT * FROM ({_RAW_ORDERS})
        WHERE year || '-' || month = ({_ORDERS_LATEST_GOOD_MONTH})
    """
    q["relanded_orders"] = f"""
        SELECT * FROM ({_RAW_ORDERS}) WHERE year || '-' || month NOT IN ({_ORDERS_BAD_MONTHS})
    """
    q["reconciled_orders"] = """
        SELECT strftime(CAST(o_orderdate AS DATE), '%Y') AS year, strftime(CAST(o_orderdate AS DATE), '%m') AS month,
               CAST(count(*) AS BIGINT) AS received_rows, CAST(count(*) AS BIGINT) AS landed_rows, true AS matches
        FROM orders GROUP BY ALL
    """
    q["dead_letter_orders"] = f"""
        SELECT * FROM ({_RAW_ORDERS}) WHERE year || '-' || month IN ({_ORDERS_BAD_MONTHS})
    """
    q["dead_letter_manifests_orders"] = f"""
        WITH {_ORDERS_META},
        c AS (SELECT strftime(o_orderdate, '%Y-%m') AS batch, {_ORDERS_COUNTS} FROM orders GROUP BY 1),
        u AS (UNPIVOT c ON COLUMNS(* EXCLUDE (batch, rows_)) INTO NAME ordinal VALUE failing_rows),
        f AS (SELECT u.batch, CAST(u.ordinal AS BIGINT) AS ordinal, m."check", m."column", m.message,
                     CAST(u.failing_rows AS BIGINT) AS failing_rows
              FROM u JOIN meta m ON CAST(u.ordinal AS BIGINT) = m.ordinal WHERE u.failing_rows > 0),
        l AS (SELECT batch, count(*) AS n,
                     string_agg('{{"check":"' || "check" || '","column":'
                                || coalesce('"' || "column" || '"', 'null')
                                || ',"message":"' || message || '","failing_rows":' || failing_rows || '}}',
                                ',' ORDER BY ordinal) AS items
              FROM f GROUP BY batch)
        SELECT '1.0.0' AS contract_version, 'orders' AS entity, false AS is_valid,
               '{{"entity":"orders","contract_version":"1.0.0","row_count":' || c.rows_
               || ',"is_valid":false,"violations":[' || l.items || ']}}' AS manifest_json,
               CAST(l.n AS BIGINT) AS n_violations, CAST(c.rows_ AS BIGINT) AS row_count,
               substr(c.batch, 1, 4) AS year, substr(c.batch, 6, 2) AS month, '01' AS day,
               'orders.parquet' AS source_file
        FROM c JOIN l ON c.batch = l.batch
    """
    q["watermark_orders"] = f"""
        SELECT 'orders' AS entity, CAST(max(date_trunc('month', o_orderdate)) AS DATE) AS watermark
        FROM orders WHERE strftime(o_orderdate, '%Y-%m') NOT IN ({_ORDERS_BAD_MONTHS})
    """
    q["watermark_report_tpch"] = f"""
        SELECT e.entity, coalesce(strftime(w.watermark, '%Y-%m-%d'), '(never loaded)') AS watermark
        FROM (VALUES ('conversations'), ('customer'), ('documents'), ('events'), ('labels'), ('lineitem'),
                     ('orders'), ('pages'), ('part'), ('supplier')) e(entity)
        LEFT JOIN (SELECT 'orders' AS entity, max(date_trunc('month', o_orderdate)) AS watermark FROM orders
                   WHERE strftime(o_orderdate, '%Y-%m') NOT IN ({_ORDERS_BAD_MONTHS})) w ON e.entity = w.entity
    """
    q["incremental_orders"] = "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01 00:00:00'"
    q["load_log_orders"] = f"""
        SELECT 'contractgate:orders:' || batch AS load_id, 'contractgate' AS pipeline, 'orders' AS target_table,
               CASE WHEN ok THEN 'success' ELSE 'failed' END AS status,
               CAST(CASE WHEN ok THEN n ELSE 0 END AS BIGINT) AS rows_loaded
        FROM (SELECT strftime(o_orderdate, '%Y') AS batch, count(*) AS n,
                     strftime(o_orderdate, '%Y') IN ({_ORDERS_VALID_YEARS}) AS ok
              FROM orders GROUP BY 1)
    """
    q["csv_orders_by_year"] = f"""
        SELECT strftime(o_orderdate, '%Y') AS year, CAST(count(*) AS BIGINT) AS rows,
               strftime(o_orderdate, '%Y') IN ({_ORDERS_VALID_YEARS}) AS accepted
        FROM orders GROUP BY 1
    """
    q["watermark_set_then_advance"] = f"""
        SELECT 'orders' AS entity,
               coalesce(CAST(max(date_trunc('month', o_orderdate)) AS DATE), DATE '1990-01-01') AS watermark
        FROM orders WHERE strftime(o_orderdate, '%Y-%m') NOT IN ({_ORDERS_BAD_MONTHS})
    """
    q["stale_loads_orders"] = f"""
        SELECT 'contractgate:orders:' || batch AS load_id, 'contractgate' AS pipeline, 'orders' AS target_table,
               'running' AS status
        FROM (SELECT DISTINCT strftime(o_orderdate, '%Y') AS batch FROM orders)
        WHERE batch NOT IN ({_ORDERS_VALID_YEARS})
    """
    q["csv_load_totals"] = f"""
        SELECT strftime(o_orderdate, '%Y') IN ({_ORDERS_VALID_YEARS}) AS accepted, CAST(count(*) AS BIGINT) AS rows
        FROM orders GROUP BY 1
    """
    q["staged_from_raw_orders"] = f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority, 'orders.parquet' AS source_file, strftime(o_orderdate, '%Y') AS year,
               strftime(o_orderdate, '%m') AS month, '01' AS day
        FROM orders
        WHERE strftime(o_orderdate, '%Y-%m') = ({_ORDERS_LATEST_GOOD_MONTH})
    """
    q["stream_landed_orders_csv"] = f"""
        SELECT year, ok AS accepted, CAST(CASE WHEN ok THEN n ELSE 0 END AS BIGINT) AS landed_rows
        FROM (SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n,
                     strftime(o_orderdate, '%Y') IN ({_ORDERS_VALID_YEARS}) AS ok
              FROM orders GROUP BY 1)
    """
    q["replayed_files_orders"] = """
        SELECT zone, CASE o_orderkey % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS kind, CAST(count(*) AS BIGINT) AS rows,
               CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders
        FROM orders, (VALUES ('raw'), ('quarantine')) z(zone) WHERE zone = 'raw' OR o_orderkey % 2 = 1 GROUP BY ALL
    """
    q["empty_day_orders"] = """
        SELECT DATE '2024-03-15' AS day, true AS found, CAST(count(*) AS BIGINT) AS reported_rows, CAST(count(*) AS BIGINT) AS staged_rows,
               CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders FROM orders
        UNION ALL SELECT DATE '2024-03-16', false, 0, 0, 0
    """
    q["manifest_order_orders"] = """
        WITH k AS (SELECT kind, count(*) AS rows FROM (
            SELECT CASE o_orderkey % 4 WHEN 0 THEN 'b' WHEN 1 THEN 'B' WHEN 2 THEN 'a10' ELSE 'a9' END AS kind FROM orders) GROUP BY kind)
        SELECT CAST(row_number() OVER (ORDER BY kind || '_') - 1 AS INT) AS position, kind, CAST(rows AS BIGINT) AS rows FROM k
    """
    q["csv_extra_fields_orders"] = """
        SELECT strftime(o_orderdate, '%Y-%m') AS month, count_if(o_orderkey % 50 = 0) = 0 AS accepted, CAST(count(*) AS BIGINT) AS rows,
               CAST(count_if(o_orderkey % 50 = 0) AS BIGINT) AS extra_rows
        FROM orders GROUP BY 1
    """
    q["ingest_parquet_summary"] = """
        SELECT 'orders' AS entity, o_orderstatus || '.parquet' AS source_file,
               'ACCEPTED orders: ' || format('{:,}', count(*)) || ' rows -> orders/year=2024/month=03/day=15/'
               || o_orderstatus || '.parquet' AS summary, 'no_contract' AS skipped
        FROM orders GROUP BY o_orderstatus
    """
    q["staged_totals_orders"] = """
        SELECT e.entity, CAST(count(*) AS BIGINT) AS rows FROM orders, (VALUES ('orders'), (NULL)) e(entity) GROUP BY e.entity
    """
    q["staged_boolean_labels"] = """
        SELECT doc_id, CASE (doc_id + quality) % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true
                                                   WHEN 3 THEN false WHEN 5 THEN true END AS quality FROM labels
    """
    q["run_load_log_orders"] = """
        SELECT 'day-2024-03-15' AS pipeline, 'raw+staged' AS target_table, 'success' AS status, CAST(count(*) AS BIGINT) AS rows_loaded FROM orders
        UNION ALL SELECT 'day-2024-03-16', 'raw+staged', 'failed', CAST(count_if(o_orderkey % 2 = 0) AS BIGINT) FROM orders
    """
    q["stale_loads_by_cutoff"] = """
        SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS load_id, 'monthly' AS pipeline, 'orders' AS target_table, 'running' AS status
        FROM orders WHERE month(o_orderdate) % 2 = 1 AND o_orderdate < TIMESTAMP '1998-07-01 00:00:00'
    """
    q["raw_calendar_columns"] = """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, strftime(o_orderdate, '%a') AS day,
               'file-' || o_custkey AS source_file, o_orderdate, strftime(o_orderdate, '%Y') AS load_year,
               strftime(o_orderdate, '%m') AS month, '01' AS load_day, 'orders.parquet' AS load_source_file
        FROM orders
    """
    q["staged_mixed_formats"] = """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority, CASE o_orderkey % 3 WHEN 0 THEN 'a.csv' WHEN 1 THEN 'b.parquet' ELSE 'c.parquet' END AS source_file,
               '2024' AS year, '03' AS month, '15' AS day
        FROM orders
    """
    q["dead_letter_mixed_columns"] = """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
               CASE WHEN o_orderkey % 2 = 0 THEN 'c' || o_custkey END AS clerk,
               CASE WHEN o_orderkey % 2 = 1 THEN 'd' || o_custkey END AS depot,
               CASE WHEN o_orderkey % 2 = 0 THEN 'a.csv' ELSE 'b.csv' END AS source_file
        FROM orders
    """
    q["restage_zero_rows"] = """
        SELECT 'first' AS step, CAST(count(*) AS BIGINT) AS reported_rows, 1 AS files, CAST(count(*) AS BIGINT) AS staged_rows FROM orders
        UNION ALL SELECT 'again', 0, 1, 0
    """
    q["csv_awkward_files"] = """
        SELECT f.source_file, f.k < 6 AS accepted, CAST(count(o_orderkey) AS BIGINT) AS rows
        FROM (VALUES (0, 'my file.csv'), (1, 'f[1].csv'), (2, '100%.csv'), (3, '_hidden.csv'), (4, '.dot.csv'),
                     (5, 'blank line.csv'), (6, 'case.csv'), (7, 'quoted.csv')) f(k, source_file)
        LEFT JOIN orders ON o_orderkey % 8 = f.k GROUP BY ALL
    """
    q["incremental_events"] = """
        SELECT event_id, CASE WHEN event_id % 100 <> 0 THEN ts END AS ts FROM events
        WHERE event_id % 100 = 0 OR CAST(ts AS DATE) > (
          SELECT CAST(make_timestamp(CAST(floor(avg(epoch_us(ts))) AS BIGINT)) AS DATE) FROM events WHERE event_id % 100 <> 0)
    """
    q["numeric_dates_orders"] = """
        SELECT 'as_text' AS what, CAST(count_if(o_orderkey % 5 <> 4) AS BIGINT) AS rows FROM orders
        UNION ALL SELECT 'numbers right', CAST(count(*) AS BIGINT) FROM orders
        UNION ALL SELECT 'texts staged', CAST(count_if(o_orderkey % 5 = 4) AS BIGINT) FROM orders
    """
    q["violations_part"] = _report(_PART_META, f"SELECT {_PART_COUNTS} FROM part", "part", "1.0.0", [])
    q["violations_supplier"] = _report(
        _SUPPLIER_META, f"SELECT {_SUPPLIER_COUNTS} FROM supplier", "supplier", "1.0.0", [])
    q["violations_conversations"] = _report(
        _CONVERSATIONS_META, f"SELECT {_CONVERSATIONS_COUNTS} FROM conversations", "conversations", "1.0.0", [])
    q["violations_pages"] = _report(_PAGES_META, f"SELECT {_PAGES_COUNTS} FROM pages", "pages", "1.0.0", [])
    if _llm is not None:
        q.update(_llm.ORACLE_SQL)
    if _pipeline is not None and _pipeline.ORACLE_SQL is not None:
        q["pipeline"] = _pipeline.ORACLE_SQL
    return {k: v for k, v in q.items() if k in queries()}
