"""Mixing sources to target weights, by hierarchical budgeting.

Documents hang in a tree: domain, language, source. A token budget goes down
from the root: at each node it is shared among the children by weight, no child
getting more than its whole subtree can give (its tokens times ``max_epochs``);
what a short child leaves goes to its siblings by their weights. A shortage
therefore reaches the siblings first, and the ancestors' other children only
when the whole subtree is short. A leaf takes as many full passes over its
documents as its budget holds and, in one more pass, the documents that come
first in that pass's own seeded order as long as their tokens fit.

DataFrame functions only, in whole numbers. A leaf is never sorted as a whole:
the order's keys are cut into 4096 ranges, token sums of the ranges find the
one in which the budget ends, and only that range is summed row by row. What is
joined to the documents is one row per leaf: budget, passes and last key.

Defined cases: null text is empty and has 0 tokens; a null domain, language or
source is a leaf of its own (empty name); unnamed weights are 1, a weight of 0
takes nothing; documents of one id (repeated rows) have one place in an order
and are taken together or not at all; a leaf without tokens gives nothing; an
empty table gives no rows; other columns are kept (those named mix_domain, mix_lang,
mix_source and mix_copies are replaced by the results).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import if_small, materialise, text_of

LEVELS = ("domain", "lang", "source")
_RANGE_CHARS = 3  # 16 ** 3 ranges of an order's keys


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit("[^ \\t\\n\\x0B\\f\\r]+")).cast("bigint")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(int(w))).otherwise(out)
    return out.cast("bigint")


def share(nodes: DataFrame, parent: list[str], level: str, weights: dict[str, dict[str, int]]) -> DataFrame:
    """``nodes`` (parent columns, ``level``, capacity, budget of the parent) with the budget of each child."""
    wide, narrow = "decimal(20,0)", "decimal(18,0)"  # their product is exact
    nodes = nodes.withColumn("w", _weight(level, weights))
    order = Window.partitionBy(*parent, F.lit(0)).orderBy(
        F.col("w") == 0, F.try_divide("capacity", F.col("w").cast("double")), level)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    nodes = nodes.withColumn("taken", F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn("ws", F.sum("w").over(after))
    full = (F.col("w") > 0) & (F.col("capacity").cast(wide) * F.col("ws").cast(narrow)
                               <= (F.col("budget") - F.col("taken")).cast(wide) * F.col("w").cast(narrow))
    nodes = nodes.withColumn("full", full)
    group = Window.partitionBy(*parent, F.lit(0))
    nodes = nodes.withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(group))
    nodes = nodes.withColumn("ws", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(group))
    part = F.expr("cast(rest as decimal(20,0)) * cast(w as decimal(18,0)) div cast(greatest(ws, 1) as decimal(18,0))")
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(part).cast("bigint")
    return nodes.withColumn("budget", budget).select(*parent, level, "capacity", "budget")


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], percent: int, max_epochs: int) -> DataFrame:
    """Leaves (domain, lang, source, tokens) with capacity and budget; the root's is ``percent`` % of all tokens."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    budget = leaves.agg((F.sum("tokens") * percent).alias("t")).select(F.expr("t div 100").alias("budget"))
    for depth, level in enumerate(LEVELS):
        parent = list(LEVELS[:depth])
        nodes = leaves.groupBy(*LEVELS[: depth + 1]).agg(F.sum("capacity").alias("capacity"))
        if parent:
            nodes = nodes.join(budget.select(*parent, "budget"), parent)
        else:
            nodes = nodes.join(F.broadcast(budget))  # one row
        budget = share(nodes, parent, level, weights)
    return leaves.drop("capacity").join(budget, list(LEVELS))


def order_key(seed: int, epoch: Column, id_column: str = "doc_id") -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))


def mix(docs: DataFrame, domain: Column, weights: dict[str, dict[str, int]], percent: int = 60, max_epochs: int = 4,
        seed: int = 1, tokens: Column | None = None) -> DataFrame:
    """``docs`` with mix_domain, mix_lang, mix_source and ``mix_copies``: how often a document is in the mixture."""
    leaf = {f"mix_{n}": F.coalesce(c.cast("string"), F.lit("")) for n, c in zip(LEVELS, (domain, F.col("lang"), F.col("source")))}
    named = docs.withColumns(leaf)
    narrow = materialise(named.select("doc_id", *[F.col(k).alias(n) for k, n in zip(leaf, LEVELS)],
                                      (word_count() if tokens is None else tokens).alias("tokens")), "mixing")
    cuts = leaf_cuts(narrow, weights, percent, max_epochs, seed)
    # under names that no other column has
    cuts = if_small(materialise(cuts.select(*[F.col(n).alias(f"mix_{n}") for n in LEVELS], F.col("passes").alias("__passes"),
                                            F.col("last_key").alias("__last_key")), "cuts"))
    key = order_key(seed, F.col("__passes"))
    copies = F.coalesce(F.col("__passes") + F.when(key <= F.col("__last_key"), 1).otherwise(0), F.lit(0)).cast("int")
    return named.join(cuts, list(leaf), "left").withColumn("mix_copies", copies).drop("__passes", "__last_key")


def leaf_cuts(narrow: DataFrame, weights: dict[str, dict[str, int]], percent: int, max_epochs: int, seed: int) -> DataFrame:
    """One row per leaf: full passes, and the last key (in the next pass's order) that still fits."""
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    plan = leaf_budgets(leaves, weights, percent, max_epochs).where("tokens > 0").select(
        *LEVELS, F.expr("budget div tokens").alias("passes"), (F.col("budget") % F.col("tokens")).alias("rest"))
    plan = materialise(plan, "mixing-leaves")
    keyed = (narrow.join(plan, list(LEVELS)).withColumn("key", order_key(seed, F.col("passes")))
             .withColumn("range", F.substring("key", 1, _RANGE_CHARS)))
    upto = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (keyed.groupBy(*LEVELS, "range").agg(F.sum("tokens").alias("n"), F.max("key").alias("top"), F.first("rest").alias("rest"))
              .withColumn("upto", F.sum("n").over(upto)))
    whole = ranges.where("upto <= rest").select(*LEVELS, F.col("top").alias("last"))
    # the range in which the budget ends: the first whose sum passes it
    split = ranges.where("upto > rest").groupBy(*LEVELS).agg(F.min(F.struct("range", "upto", "n")).alias("s")).select(
        *LEVELS, F.col("s.range").alias("range"), (F.col("s.upto") - F.col("s.n")).alias("before"))
    inside = keyed.join(split, [*LEVELS, "range"]).groupBy(*LEVELS, "range", "key").agg(
        F.sum("tokens").alias("n"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    run = Window.partitionBy(*LEVELS, "range").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = inside.withColumn("upto", F.col("before") + F.sum("n").over(run)).where("upto <= rest").select(*LEVELS, F.col("key").alias("last"))
    last = whole.unionByName(within).groupBy(*LEVELS).agg(F.max("last").alias("last_key"))
    return plan.join(last, list(LEVELS), "left")


def oracle(domain_sql: str, weights: dict[str, dict[str, int]], percent: int, max_epochs: int, seed: int) -> str:
    """The same mixture as SQL over the table documents."""

    def weight(level: str) -> str:
        cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.get(level, {}).items())
        return f"CASE {level} {cases} ELSE 1 END" if cases else "1"

    sql = f"""WITH d AS (
        SELECT doc_id, coalesce({domain_sql}, '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS tokens FROM documents),
      leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens, sum(tokens) * {max_epochs} AS capacity FROM d GROUP BY ALL),
      b_root AS (SELECT sum(tokens) * {percent} // 100 AS budget FROM leaves)"""
    above = "b_root"
    for depth, level in enumerate(LEVELS):
        names, parent = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
        part = f"PARTITION BY {parent}" if parent else ""
        using = f"JOIN {above} USING ({parent})" if parent else f"CROSS JOIN {above}"
        sql += f""",
      n_{level} AS (SELECT *, {weight(level)} AS w FROM (SELECT {names}, sum(capacity) AS capacity FROM leaves GROUP BY ALL) {using}),
      o_{level} AS (SELECT *,
          coalesce(sum(capacity) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
          sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
        FROM n_{level} WINDOW q AS ({part} ORDER BY w = 0, capacity / w::DOUBLE, {level})),
      f_{level} AS (SELECT *, w > 0 AND capacity * ws <= (budget - taken) * w AS full_ FROM o_{level}),
      b_{level} AS (SELECT {names}, CASE WHEN full_ THEN capacity ELSE
          (budget - sum(CASE WHEN full_ THEN capacity ELSE 0 END) OVER ({part})) * w
          // greatest(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER ({part}), 1) END AS budget FROM f_{level})"""
        above = f"b_{level}"
    return sql + f""",
      plan AS (SELECT domain, lang, source, budget // tokens AS passes, budget % tokens AS rest
               FROM leaves JOIN b_source USING (domain, lang, source) WHERE tokens > 0),
      k AS (SELECT d.*, passes, rest, md5('{seed}:' || passes || ':' || doc_id) AS key
            FROM d LEFT JOIN plan USING (domain, lang, source))
    SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens,
           CAST(coalesce(passes + CASE WHEN sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) <= rest
                                       THEN 1 ELSE 0 END, 0) AS INT) AS copies
    FROM k"""
