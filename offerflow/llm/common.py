"""Helpers shared by the corpus operators: words, written tables, distributed ranks, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerflow.workdir import written

#: A word: a run without space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_INDEX = (1 << 33) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column | str) -> Column:
    """Number of words of a text; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: list[Column], rank: str = "rank", sums: tuple[str, ...] = ()) -> DataFrame:
    """Add the 0-based place of every row in a total order, and prefix sums, without a global window.

    The rows are range-partitioned and sorted once and written; a row's place is its place in
    its partition plus the sizes of the partitions before it. Only one row per partition is
    broadcast. ``sums``: columns of which ``<name>_before`` becomes the sum over all earlier
    rows. Rows that tie in the order get distinct places. The result is written, so places
    never change between uses.
    """
    rows = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    totals = rows.groupBy("_part").agg(F.count("*").alias("_n"), *(F.sum(c).alias(f"_{c}") for c in sums))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}")
                                      for c in ("_n", *(f"_{c}" for c in sums))))
    found = rows.join(F.broadcast(starts), "_part")
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    for c in sums:
        found = found.withColumn(f"{c}_before", F.col(f"_before__{c}") + F.coalesce(F.sum(c).over(within), F.lit(0)))
    found = found.withColumn(rank, F.col("_before__n") + F.col("_at").bitwiseAND(F.lit(_INDEX)))
    return found.drop("_at", "_part", "_before__n", *(f"_before__{c}" for c in sums))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes by the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links ``a``, ``b`` (longs): a row (node, root) for every linked node.

    ``root`` is the smallest node of the component and has a row of its own. Alternates large-star
    and small-star steps: every step is a minimum per node, combined before the shuffle, and
    a join; nodes with very many links are never gathered. Each step's links are written, which
    also cuts the lineage. Self links and repeated links are ignored.
    """
    links = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    state = None
    while True:
        found = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if found == state:
            break
        state = found
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = written(large.distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = written(small.union(low.select("a", F.col("low").alias("b"))).distinct(), "small-star")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
