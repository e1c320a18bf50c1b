"""Mix sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow.llm.common import n_words, ranked


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Target words per source: shares by weight of all words, none above ``most`` times the source's own words.

    ``sources``: ``source``, ``source_size`` (long), a row each. Sources by code point, null
    last, take the weights in turn. With sources in order of the level ``most * size / weight`` at
    which each is full, the level L that the others reach when all before one source are full is
    (all words - their limits) / (weights that are left); the final level is the largest of these,
    and a target is ``min(most * size, weight * L)``. The order is found by distributed ranks, so
    the number of sources is not limited.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    named = ranked(sources, [F.col("source").asc_nulls_last()], "place")
    named = named.withColumn("weight", weight.cast("long")).withColumn("full", F.col("source_size") * most)
    full = ranked(named, [(F.col("full") / F.col("weight")).asc(), F.col("place").asc()], "turn", sums=("weight", "full"))
    total = full.agg(F.sum("source_size"), F.sum("weight")).first()
    words, parts = (total[0] or 0), (total[1] or 0)
    level = full.agg(F.max((F.lit(words) - F.col("full_before")).cast("double")
                           / (F.lit(parts) - F.col("weight_before")).cast("double"))).first()[0] or 0.0
    target = F.least(F.col("full").cast("double"), F.col("weight").cast("double") * F.lit(level))
    return full.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: str) -> Column:
    """The one random number in [0, 1) of a source: the same in every run with the same seed."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("\n")))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 32)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix", keep: tuple[str, ...] | None = None,
        ) -> DataFrame:
    """How often the mix takes every document: ``row``, ``source``, ``size``, ``source_size``, ``target``, ``copies``.

    Within its source every document has the same expected number of copies e = target /
    source size (at most ``most``). In order of size and key the expected copies are summed up,
    the source's offset is added, and a document is taken once per integer that its step
    crosses: its copies are e rounded down or up. Neighbours in this order have like sizes, so
    the taken words stay within about one document of the target.

    ``row`` holds the columns ``keep`` of the document (all unless given), under their own names in
    a struct, so no extra column can clash. Null text: size 0. Null source: a source of its own.
    A source without words has target 0 and gives nothing. Null keys come first in order. Repeated rows are
    separate documents, equal ones in any order. An empty table gives an empty result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)])
    sized = docs.select(row.alias("row"), F.col(source).cast("string").alias("source"), F.col(key).alias("key"),
                        n_words(F.col(text)).alias("size"))
    order = [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("key").asc_nulls_first()]
    placed = ranked(sized, order, "place")
    sources = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("place").alias("first"))
    aimed = targets(sources.select("source", "source_size"), weights, most)
    begins = sources.select(F.col("source").alias("s1"), "first")
    aimed = aimed.join(begins, aimed["source"].eqNullSafe(begins["s1"])).select(
        F.col("source").alias("s"), "source_size", "target", "first")
    found = placed.join(aimed, placed["source"].eqNullSafe(aimed["s"]))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(0.0)
    before = (F.col("place") - F.col("first")).cast("double")
    shift = offset(F.col("source"), seed)
    copies = F.floor((before + 1.0) * expected + shift) - F.floor(before * expected + shift)
    return found.select("row", "source", "size", "source_size", "target",
                        F.least(copies, F.lit(most)).cast("long").alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every taken document as often as it is taken, with the columns of ``docs``."""
    taken = mix(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
