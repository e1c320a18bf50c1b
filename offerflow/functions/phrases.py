"""Key phrases of a text: candidate phrases scored by word degree over frequency.

The published rapid keyword extraction scheme stands in for the noun chunks of a
pretrained model: candidates are runs of at most four words between stop words and
punctuation, a word scores degree / frequency, a phrase the sum of its words. Everything
is computed inside the row; sorted arrays take the place of groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow import rules
from offerflow.functions.labels import let

_BREAK = r"[^\p{L}\p{N}'\- \t\n]|\n"
_TOKEN = r"[\p{L}\p{N}][\p{L}\p{N}'\-]*"


def candidate_phrases(text: Column) -> Column:
    """Candidate phrases of a text, repeated as often as they occur."""
    lowered = F.regexp_replace(F.lower(text), _BREAK, " | ")
    tokens = F.regexp_extract_all(lowered, F.lit(rf"{_TOKEN}|\|"), 0)
    marked = F.array_join(F.transform(tokens, lambda t: F.when(t.isin(*rules.STOP_WORDS), "|").otherwise(t)), " ")
    phrases = F.transform(F.split(marked, r"\|"), lambda p: F.trim(p))
    return F.filter(phrases, lambda p: (p != "") & (F.size(F.split(p, " ")) <= rules.MAX_PHRASE_WORDS))


def _runs(ordered: Column, key: Callable[[Column], Column]) -> Column:
    """The slices of equal key of a sorted array."""
    def cut(rows: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(1), F.size(rows)), lambda i: (i == 1) | (
            key(F.element_at(rows, i)) != key(F.element_at(rows, F.greatest(i - 1, F.lit(1))))))
        return let(begins, lambda at: F.transform(at, lambda begin, n: F.slice(
            rows, begin, F.coalesce(F.get(at, n + 1), F.size(rows) + 1) - begin)))

    return let(ordered, lambda rows: F.when(F.size(rows) > 0, cut(rows)).otherwise(F.slice(F.array(rows), 1, 0)))


def _total(rows: Column, value: Callable[[Column], Column], zero: Column) -> Column:
    return F.aggregate(rows, zero, lambda s, r: s + value(r))


def ranked_phrases(candidates: Column) -> Column:
    """The best phrases, by score and then by name."""
    counted = F.transform(_runs(F.array_sort(candidates), lambda p: p), lambda run: F.struct(
        F.element_at(run, 1).alias("phrase"), F.size(run).alias("n")))

    def of_words(phrases: Column) -> Column:
        def words_of(p: Column) -> Column:
            return let(F.split(p["phrase"], " "), lambda words: F.transform(words, lambda w: F.struct(
                w.alias("word"), p["phrase"].alias("phrase"), p["n"].alias("n"), (p["n"] * F.size(words)).alias("degree"))))

        runs = _runs(F.array_sort(F.flatten(F.transform(phrases, words_of))), lambda r: r["word"])
        return F.flatten(F.transform(runs, lambda run: let(
            _total(run, lambda r: r["degree"], F.lit(0)) / _total(run, lambda r: r["n"], F.lit(0)),
            lambda weight: F.transform(run, lambda r: F.struct(r["phrase"].alias("phrase"), weight.alias("weight"))))))

    scored = F.transform(_runs(F.array_sort(let(counted, of_words)), lambda r: r["phrase"]), lambda run: F.struct(
        (-F.round(_total(run, lambda r: r["weight"], F.lit(0.0)), 6)).alias("order"),
        F.element_at(run, 1)["phrase"].alias("phrase")))
    best = F.slice(F.array_sort(scored), 1, rules.MAX_KEY_PHRASES)
    return F.transform(best, lambda r: r["phrase"])


def with_phrases(df: DataFrame, text: str, out: str) -> DataFrame:
    """Append ``out``, the ranked phrases of column ``text`` (empty where it has none)."""
    found = df.withColumn("_candidates", F.coalesce(candidate_phrases(F.col(text)), F.array().cast("array<string>")))
    return found.withColumn(out, ranked_phrases(F.col("_candidates"))).drop("_candidates")
