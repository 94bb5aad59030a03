"""Links between ids that share buckets, and connected groups of links.

Both work with ordinary joins and aggregations: no bucket and no group is
gathered in one task, and of a large bucket only the pairs are written out
that can still join two classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, if_small, materialise

# Buckets up to this size compare every member with every other.
SMALL = 12
# Pairs that are worth a job of their own.
LEAST_AT_ONCE = 1 << 17
# Pairs of members of different classes, those of each bucket by themselves, that are shuffled at once.
CROSS_AT_ONCE = 1 << 22


def _repeated(similarity: float):
    """Of rows sorted by bucket and size, those beside one of the same bucket and a size near enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, alone = None, None  # bucket and size of the last row, and that row while it has no neighbour
        for batch in batches:
            bucket, size = batch.column("bucket").to_numpy(), batch.column("size").to_numpy()
            if not len(bucket):
                continue
            same = (bucket[1:] == bucket[:-1]) & (size[1:] - size[:-1] <= (1 - similarity) * size[1:] + 1e-9)
            keep = np.zeros(len(bucket), dtype=bool)
            keep[1:] |= same
            keep[:-1] |= same
            if last is not None and bucket[0] == last[0] and size[0] - last[1] <= (1 - similarity) * size[0] + 1e-9:
                keep[0] = True
                if alone is not None:
                    yield alone
            last, alone = (bucket[-1], size[-1]), None if keep[-1] else batch.slice(len(bucket) - 1)
            if keep.any():
                yield batch.filter(pa.array(keep))

    return run


def shared_buckets(members: DataFrame, similarity: float = 0.0) -> DataFrame:
    """The rows of ``members`` that may be linked with another of their bucket, written out.

    Two rows cannot be if their sizes (all alike if there is no such column)
    differ by more than ``1 - similarity`` of the larger; sorted by size, a row
    without a neighbour near enough has no partner at all. One shuffle of narrow
    rows, sorted by Spark and read as a stream, so a bucket of any size takes no
    more memory than a batch of rows.
    """
    if "size" not in members.columns:
        members = members.withColumn("size", F.lit(0))
    ordered = members.repartition("bucket").sortWithinPartitions("bucket", "size")
    return materialise(ordered.mapInArrow(_repeated(similarity), members.schema), "shared")


def in_slices(pairs: DataFrame, at_once: int, verified: Callable[..., DataFrame], fetched: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``verified`` of all ``pairs`` (a written table), about ``at_once`` of them at a time.

    ``fetched`` gives the texts of all pairs, written out once; ``verified`` then gets them with every slice.

    A pair travels with both its texts, and what one slice shuffles is gone before the
    next: on disk there is never more than ``at_once`` pairs of texts. A pair's slice is a hash of both its
    ids, so an id of very many pairs is spread over all of them.
    """
    slices = max(1, -(-pairs.count() // max(at_once, 1)))  # 1 if there are no pairs
    texts = [fetched(pairs)] if fetched else []
    if slices == 1:
        links = verified(pairs, *texts)
        discard(*texts)
        return links
    parts = [verified(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(slices)) == k), *texts) for k in range(slices)]
    discard(*texts)
    links = parts[0]
    for part in parts[1:]:
        links = links.unionByName(part)
    links = materialise(links, "links")
    discard(*parts)
    return links


def linked(members: DataFrame | list[DataFrame], verified: Callable[..., DataFrame],
           looks: Callable[[DataFrame], DataFrame] | None = None, similarity: float = 0.0, at_once: int = 1 << 62,
           fetched: Callable[[DataFrame], DataFrame] | None = None, cross_at_once: int = 0) -> DataFrame:
    """``components`` of all verified links between ids that share a bucket.

    ``members``: bucket, id, next (a second bucket of the same id), or a list of
    such tables with different buckets, which are shuffled one after another;
    ``looks`` adds next to the members of large buckets where they come without;
    a column size rules out pairs whose sizes differ by more than ``1 - similarity`` of the larger;
    ``verified`` takes distinct pairs a < b and gives those that are links, written out; it gets
    about ``at_once`` pairs at a time, and the texts of all pairs if ``fetched`` gives them;
    ``cross_at_once`` may be above ``CROSS_AT_ONCE`` where ids stand for much text.

    * Up to ``SMALL`` members of a bucket give all their pairs.
    * In a larger bucket each member is first compared with the bucket's first id
      and with the first id of those members that share its ``next`` bucket too.
      What these links join needs no more pairs, so a bucket of copies is done.
    * Of the large buckets that hold several classes after that, every pair of
      members of different classes is compared: classes of a bucket meet first,
      then the members of both. So the result is that of all pairs.
    """
    # nearly every bucket has one member and goes in the first pass
    slices = [shared_buckets(m, similarity) for m in (members if isinstance(members, list) else [members])]
    shared = slices[0]
    for other in slices[1:]:
        shared = shared.unionByName(other)
    counts = materialise(shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "size")).alias("first")), "buckets")
    more = materialise(shared.join(if_small(counts), "bucket"), "members")
    discard(counts, *slices)
    near = F.abs(F.col("size_a") - F.col("size_b")) <= F.lit(1 - similarity) * F.greatest("size_a", "size_b") + 1e-9

    def side(df: DataFrame, letter: str, *keys: str) -> DataFrame:
        return df.select(*keys, F.col("id").alias(letter), F.col("size").alias(f"size_{letter}"))

    few = more.where(F.col("n") <= SMALL)
    pairs = side(few, "a", "bucket").join(side(few, "b", "bucket"), "bucket").where("a < b").where(near).select("a", "b")
    many = more.where(F.col("n") > SMALL)
    scratch = [more]
    if looks:
        many = materialise(looks(many), "many")
        scratch.append(many)
    from_first = many.select(F.col("first.id").alias("a"), F.col("first.size").alias("size_a"), F.col("id").alias("b"), F.col("size").alias("size_b"))
    centres = many.groupBy("bucket", "next").agg(F.min(F.struct("id", "size")).alias("centre"))
    from_centre = many.join(centres, ["bucket", "next"]).select(
        F.col("centre.id").alias("a"), F.col("centre.size").alias("size_a"), F.col("id").alias("b"), F.col("size").alias("size_b"))
    stars, inner = (df.where("a < b").where(near).select("a", "b") for df in (from_first, from_centre))
    first_pairs = materialise(pairs.unionByName(stars).unionByName(inner).distinct(), "pairs")
    links = in_slices(first_pairs, at_once, verified, fetched)
    labels = materialise(components(links), "classes")
    placed = many.select("bucket", "id", "size").join(labels.hint("merge"), "id", "left").select("bucket", "id", "size", F.coalesce("label", "id").alias("class"))
    placed = materialise(placed, "placed")
    parts = materialise(placed.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n")), "parts")
    # the same two classes often meet in many buckets; their members differ from bucket to bucket
    sums = parts.groupBy("bucket").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("own"))
    crossing = sums.agg(F.coalesce(F.sum((F.col("all").cast("double") * F.col("all") - F.col("own")) / 2), F.lit(0.0)).alias("n")).first().n
    here, there = (parts.select("bucket", F.col("class").alias(c)) for c in ("class_a", "class_b"))
    meet = here.hint("merge").join(there, "bucket").where("class_a < class_b")
    # all the buckets in which a pair meets are in one slice, so that it is told apart there
    slices = max(1, -(-int(crossing) // max(cross_at_once, CROSS_AT_ONCE)))
    side_a, side_b = (side(placed.withColumnRenamed("class", f"class_{s}"), s, "bucket", f"class_{s}").hint("merge") for s in "ab")
    more_pairs = []
    for k in range(slices if crossing else 0):
        some = meet.where(F.pmod(F.xxhash64("class_a", "class_b"), F.lit(slices)) == k) if slices > 1 else meet
        cross = some.join(side_a, ["bucket", "class_a"]).join(side_b, ["bucket", "class_b"]).where(near)
        cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        more_pairs.append(materialise(cross.join(first_pairs.hint("merge"), ["a", "b"], "left_anti"), "more-pairs"))
    discard(*scratch, first_pairs, placed, parts)
    rest = reduce(DataFrame.unionByName, more_pairs) if more_pairs else None
    if rest is not None and rest.limit(1).count():
        found = in_slices(rest, at_once, verified, fetched)
        discard(labels)
        labels = materialise(components(links.unionByName(found)), "classes")
        discard(found)
    discard(*more_pairs)
    discard(links)
    return labels


def components(links: DataFrame) -> DataFrame:
    """id, label (the smallest id of its connected group) of every id in ``links`` (a, b).

    Labels spread along links and then jump to their label's label, until
    nothing changes: a few rounds for star-shaped groups, about the logarithm
    of the length for chains. Each round is written out.
    """
    edges = materialise(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select("id", F.least("id", "low").alias("label"))
    labels = materialise(labels, "labels")
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), F.col("label").alias("near")), "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        step = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("id").alias("new"), F.col("label").alias("far"))
        step = step.join(jump, "new", "left").select("id", "label", F.least("new", F.coalesce("far", "new")).alias("new"))
        before, step = labels, materialise(step, "labels")
        discard(before)
        if not step.where("new < label").limit(1).count():
            discard(edges)
            return step.select("id", F.col("new").alias("label"))
        labels = step.select("id", F.col("new").alias("label"))
        labels.scratch = step.scratch
