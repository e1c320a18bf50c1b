"""Keyed building blocks that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the smallest by ``order``.

    An aggregate, not a window: every map task keeps one row per key before the
    shuffle, so a hot key costs one row per task.
    """
    return _pick(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the largest by ``order``."""
    return _pick(df, keys, order, F.max_by)


def left_join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join for a right side that may repeat a key very often.

    Adaptive execution can split a skewed partition of an outer join only on the
    preserved side. An inner join can be split on both, so the matches are an inner
    join, and the rows without a match come from an anti join on distinct keys.
    """
    matched = left.join(right, key, "inner")
    missing = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)


def _digits(value: Column) -> Column:
    """A bigint as 16 hexadecimal digits in numeric order, negative values first."""
    return F.lpad(F.hex(value.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def exact_median(df: DataFrame, value: Column, out: str) -> DataFrame:
    """One row with the continuous median of a bigint (NULL without values).

    Values are counted before anything is ordered. The counts are summed up by their first four
    hexadecimal digits; the one or two prefixes that hold the middle ranks are opened to eight digits, and so on.
    A step orders at most 2 x 65,536 sums, whatever the values are.
    """
    return median_of_counts(df.select(value.cast("bigint").alias("_value")).where("_value IS NOT NULL")
                            .groupBy("_value").agg(F.count(F.lit(1)).alias("_n")), out)


def median_of_counts(counts: DataFrame, out: str) -> DataFrame:
    """The same from distinct bigints ``_value`` and how often each occurs, ``_n``."""
    counts = counts.select("_value", "_n", _digits(F.col("_value")).alias("_digits"))
    total = counts.agg(F.sum("_n").alias("_total"))
    opened = total.select(F.lit("").alias("_prefix"), F.lit(0).cast("bigint").alias("_before"), "_total")
    for length in (4, 8, 12, 16):
        inside = counts.join(F.broadcast(opened), F.substring("_digits", 1, length - 4) == F.col("_prefix"))
        sums = inside.groupBy("_prefix", "_before", "_total", F.substring("_digits", 1, length).alias("_longer")) \
            .agg(F.sum("_n").alias("_n"))
        upto = F.col("_before") + F.sum("_n").over(Window.partitionBy("_prefix").orderBy("_longer"))
        placed = sums.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))
        holds = F.expr("(_before <= (_total - 1) div 2 AND (_total - 1) div 2 < _upto)"
                       " OR (_before <= _total div 2 AND _total div 2 < _upto)")
        opened = placed.where(holds).select(F.col("_longer").alias("_prefix"), "_before", "_total")  # one or two rows
    middle = counts.join(F.broadcast(opened), F.col("_digits") == F.col("_prefix"))
    return middle.agg(F.avg("_value").alias(out))


def single_row(pieces: list[DataFrame]) -> DataFrame:
    """Put the columns of several one-row frames side by side, without a cross join."""
    merged = pieces[0]
    for piece in pieces[1:]:
        merged = merged.unionByName(piece, allowMissingColumns=True)
    return merged.agg(*[F.any_value(c, True).alias(c) for c in merged.columns])
