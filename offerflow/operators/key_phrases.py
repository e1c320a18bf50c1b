"""Key phrases per offer, and the phrases of all offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow.functions.labels import let
from offerflow.functions.phrases import candidate_phrases, with_phrases
from offerflow.workdir import written


def key_phrases(offers: DataFrame, key: str, text: str, out: str = "key_phrases") -> DataFrame:
    """(key, ranked phrases) for every offer that has any; nothing is exchanged."""
    found = with_phrases(offers.select(key, text), text, "_ranked")
    # The rows of an outer explode are filtered after it; a filter on the phrases would compute them twice.
    given = found.select(key, F.explode_outer(F.when(F.size("_ranked") > 0, F.array("_ranked"))).alias(out))
    return given.where(F.col(out).isNotNull())


def corpus_phrases(offers: DataFrame, text: str) -> DataFrame:
    """Every candidate phrase of the offers with ``n`` (occurrences inside longer ones included), ``longer`` and its C-value.

    A phrase inside longer candidates counts for itself only as far as it is commoner than they are: its value is
    log2(1 + words) x (n - mean n of the ``longer`` distinct candidates that hold it). Occurrences are counted before anything is
    exchanged; from there on all steps are joins and sums over distinct phrases, of at most four words and nine shorter spans each.
    """
    found = offers.select(F.explode_outer(candidate_phrases(F.col(text))).alias("phrase")).where("phrase IS NOT NULL")
    own = written(found.groupBy("phrase").agg(F.count(F.lit(1)).alias("own")), "phrases")
    words = F.split("phrase", " ")
    spans = let(words, lambda w: F.flatten(F.transform(F.sequence(F.lit(1), F.size(w)), lambda begin: F.transform(
        F.sequence(F.lit(1), F.size(w) - begin + 1), lambda size: F.array_join(F.slice(w, begin, size), " ")))))
    longer = F.size(words) > 1

    def inside(rows: DataFrame, held: Column, value: str) -> DataFrame:
        """Shorter phrases with a value of each phrase that holds them; a phrase is one row, so its spans need not meet those of others."""
        return rows.where(longer).select(F.col("phrase").alias("whole"), value, F.explode(held).alias("phrase")).where("phrase <> whole")

    nested = inside(own, spans, "own").groupBy("phrase").agg(F.sum("own").alias("times"))
    total = written(own.join(nested, "phrase", "left").select("phrase", (F.col("own") + F.coalesce("times", F.lit(0))).alias("n")), "phrase-totals")
    above = inside(total, F.array_distinct(spans), "n").groupBy("phrase").agg(F.count(F.lit(1)).alias("longer"), F.sum("n").alias("above"))
    worth = F.col("n") - F.coalesce(F.try_divide("above", "longer"), F.lit(0.0))
    return total.join(above, "phrase", "left").select(
        "phrase", "n", F.coalesce("longer", F.lit(0)).alias("longer"), F.round(F.log2(F.size(words) + 1) * worth, 6).alias("value"))
