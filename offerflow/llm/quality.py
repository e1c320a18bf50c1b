"""Quality rules: document statistics, and decision lists learned from labelled statistics. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow.llm.common import written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

#: Rates per word, line or character, so that no rule asks how long a text is.
FEATURES = ("symbol_rate", "duplicate_line_rate", "repeat_rate", "capital_rate", "digit_rate", "shout_rate", "bar_rate", "word_length")
#: Quantiles of good and of bad labelled rows that serve as thresholds, for each feature.
QUANTILES = 32


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the document's columns), ``key``, the base statistics and the features of ``FEATURES``.

    ``n_repeat_words`` counts the words that lie in windows of 8 words found more than once in the text:
    windows are hashed and sorted, neighbours of equal hash are repeats, and overlaps count once. Null and empty
    texts have zero everywhere. All of it is array expressions inside the row, so nothing is shuffled.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"), F.col(key).alias("key"), F.length(value).alias("chars"),
        F.filter(F.split(value, SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(value, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))).alias("lines"),
        *[F.regexp_count(value, F.lit(p)).cast("long").alias(n) for n, p in (
            ("n_symbols", SYMBOLS), ("n_capitals", r"\p{Lu}"), ("n_digits", "[0-9]"), ("n_shouts", "!"), ("n_bars", r"\|"))])
    windows = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
        lambda i: F.struct(F.xxhash64(F.slice("words", i, WINDOW)).alias("h"), i.alias("at"))))
    rows = rows.select(
        "row", "key", "chars", "n_symbols", "n_capitals", "n_digits", "n_shouts", "n_bars",
        F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(windows, F.array().cast("array<struct<h:bigint,at:int>>")).alias("windows"))
    some = F.size(F.array_distinct(F.col("windows.h"))) < F.size("windows")
    rows = rows.withColumn("ordered", F.when(some, F.sort_array("windows"))).drop("windows")
    last = F.size("ordered") - 1
    repeats = F.filter("ordered", lambda w, i: (
        ((i > 0) & (F.get("ordered", F.greatest(i - 1, F.lit(0)))["h"] == w["h"]))
        | ((i < last) & (F.get("ordered", F.least(i + 1, last))["h"] == w["h"]))))
    rows = rows.withColumn("places", F.sort_array(F.transform(repeats, lambda w: w["at"]))).drop("ordered")
    covered = F.aggregate(
        "places", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n")),
        lambda s: s["n"])
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("places")

    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    found = rows.select("row", "key", F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", rate("n_symbols", "n_words").alias("symbol_rate"),
        rate("n_dup_lines", "n_lines").alias("duplicate_line_rate"), rate("n_repeat_words", "n_words").alias("repeat_rate"),
        rate("n_capitals", "chars").alias("capital_rate"), rate("n_digits", "chars").alias("digit_rate"),
        rate("n_shouts", "n_words").alias("shout_rate"), rate("n_bars", "n_words").alias("bar_rate"),
        rate("word_chars", "n_words").alias("word_length")).alias("found"))
    # one row each: a later filter cannot be pushed below it, with all expressions copied into the filter
    return found.select("row", "key", F.inline(F.array("found")))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    found = F.lit(True)
    for condition in rule:
        found = found & condition.column()
    return found


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: the number of the first rule that holds, 0 if none does."""
    found = None
    for number, rule in enumerate(rules, 1):
        found = F.when(holds(rule), number) if found is None else found.when(holds(rule), number)
    return F.lit(0) if found is None else found.otherwise(0)


def _with_labels(stats: DataFrame, labels: DataFrame, key: str, quality: str) -> DataFrame:
    """``grow`` (two thirds of the keys), ``bad`` and the features of labelled rows.

    Labels that repeat a key count as bad if any is. Rows without a key or label teach nothing.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(F.col(key).alias("labelled")).agg(
        (F.min(quality) < 1).alias("bad"))
    third = F.pmod(F.xxhash64("key"), F.lit(3))
    return stats.join(known, stats["key"] == known["labelled"]).select((third > 0).alias("grow"), "bad", *FEATURES)


def thresholds(rows: DataFrame, parts: int = QUANTILES) -> dict[str, list[float]]:
    """Candidate thresholds of each feature: zero and the quantiles of the good and of the bad labelled rows.

    Values are counted with three significant digits, so what comes to the driver is bounded by the digits and
    not by the rows. The quantiles are exact quantiles of these values.
    """
    values = F.array(*[F.struct(F.lit(f).alias("f"), F.format_string("%.2e", F.col(f)).cast("double").alias("v")) for f in FEATURES])
    counts: dict[tuple[str, bool], list[tuple[float, int]]] = {}
    for r in rows.select("bad", F.explode(values).alias("at")).groupBy("at.f", "bad", "at.v").agg(F.count("*").alias("n")).collect():
        counts.setdefault((r["f"], r["bad"]), []).append((r["v"], r["n"]))
    found = {f: {0.0} for f in FEATURES}
    for (feature, _), seen in counts.items():
        seen.sort()
        total, so_far, part = sum(n for _, n in seen), 0, 1
        for value, n in seen:
            so_far += n
            while part < parts and so_far * parts >= total * part:
                found[feature].add(value)
                part += 1
        found[feature].add(seen[-1][0])
    return {f: sorted(found[f]) for f in FEATURES}


Cells = tuple[DataFrame, dict[str, list[float]]]


def labelled(stats: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> Cells:
    """Labelled rows as written cells (``grow``, ``bad``, for each feature the number of thresholds below it, ``n``
    rows), and the thresholds."""
    rows = _with_labels(stats, labels, key, quality)
    limits = thresholds(rows)

    def below(feature: str) -> Column:
        return F.size(F.filter(F.lit(limits[feature]), lambda limit: limit < F.col(feature))).alias(feature)

    return written(rows.select("grow", "bad", *[below(f) for f in FEATURES]).groupBy("grow", "bad", *FEATURES).agg(F.count("*").alias("n")), "labelled-cells"), limits


def _holds(rule: Rule, limits: dict[str, list[float]]) -> Column:
    """The rule on cells: a feature is above a threshold if more thresholds lie below it than below that threshold."""
    found = F.lit(True)
    for c in rule:
        at = limits[c.feature].index(c.threshold)
        found = found & (F.col(c.feature) > at if c.above else F.col(c.feature) <= at)
    return found


def _counts(cells: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
    """(feature, bin) -> (bad, good): at most one row per feature and threshold comes to the driver."""
    bins = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in FEATURES])
    found = cells.select("bad", "n", F.explode(bins).alias("at")).groupBy("at.f", "at.bin").agg(
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("q"))
    return {(r["f"], r["bin"]): (r["p"], r["q"]) for r in found.collect()}


def _best(counts: dict[tuple[str, int], tuple[int, int]], limits: dict[str, list[float]],
          barred: set[tuple[str, bool]]) -> tuple[Condition | None, int]:
    """The condition of highest gain (Quinlan), and the good rows that stay: bad rows that stay, times the information won on each.

    Where neighbouring thresholds part the rows alike, the middle one is taken: a rule keeps its
    distance from both sides. ``barred``: features and directions not to use.
    """
    all_p = sum(p for (f, _), (p, _) in counts.items() if f == FEATURES[0])
    all_q = sum(q for (f, _), (_, q) in counts.items() if f == FEATURES[0])
    if not all_p or not all_q:
        return None, all_q
    best, tied = (0.0, "", False, 0, 0), []
    for feature in FEATURES:
        low_p = low_q = 0
        for i, threshold in enumerate(limits[feature]):
            p, q = counts.get((feature, i), (0, 0))
            low_p, low_q = low_p + p, low_q + q
            for above, p, q in ((False, low_p, low_q), (True, all_p - low_p, all_q - low_q)):
                if (feature, above) in barred:
                    continue
                gain = p * (math.log2(p / (p + q)) - math.log2(all_p / (all_p + all_q))) if p else 0.0
                if (feature, above, p, q) == best[1:]:
                    tied.append(threshold)
                elif gain > best[0] + 1e-9:
                    best, tied = (gain, feature, above, p, q), [threshold]
    _, feature, above, _, q = best
    return (Condition(feature, above, tied[len(tied) // 2]) if tied else None), q


def learn(cells: Cells, precision: float = 0.95, least: int = 3) -> list[Rule]:
    """Sequential covering: ordered rules for bad documents.

    A rule grows by the condition of highest gain on the growing rows until no good row is left or no condition gains, then
    loses its last conditions as long as that lifts (bad - good) / (bad + good) on the pruning rows. It joins
    the list if at least ``precision`` of the labelled rows it newly covers are bad and these are ``least`` or more, both among all
    rows and among the pruning rows alone, which it has not grown on; what it covers leaves both sets. If it fails, the next rule may not begin with that feature in that direction, so a
    noisy kind of documents does not hide the others. Learning ends when no beginning is left; the number of rules and conditions
    is not limited. No labels, or labels of one kind, give no rule. All labelled rows are used; each step is one
    aggregate over their cells.
    """
    rows, limits = cells
    rules: list[Rule] = []
    left, barred, beginnings = rows, set(), None
    while True:
        if beginnings is None:
            beginnings = _counts(left.where("grow"))
        first, q = _best(beginnings, limits, barred)
        if first is None:
            return rules
        rule: Rule = (first,)
        while q:
            condition, rest = _best(_counts(left.where(F.col("grow") & _holds(rule, limits))), limits, set())
            if condition is None:
                break
            rule, q = (*rule, condition), rest
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        sums = [F.sum(F.when(_holds(r, limits) & (F.col("grow") == g) & (F.col("bad") == b), F.col("n")).otherwise(0))
                for r in prefixes for g in (True, False) for b in (True, False)]
        found = [v or 0 for v in left.agg(*sums).first()]
        scored = []
        for k, r in enumerate(prefixes):
            grow_p, grow_q, p, q = found[4 * k:4 * k + 4]
            sure = all(a >= least and a >= precision * (a + b) for a, b in ((p, q), (p + grow_p, q + grow_q)))
            scored.append(((p - q) / (p + q) if p + q else -1.0, -len(r), r, sure))
        # the longest form is the purest: it is tried where pruning went too far
        for _, _, rule, sure in (max(scored, key=lambda s: s[:2]), scored[-1]):
            if sure:
                rules.append(rule)
                left, barred, beginnings = left.where(~_holds(rule, limits)), set(), None
                break
        else:
            barred = barred | {(first.feature, first.above)}


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", keep: bool = True) -> DataFrame:
    """Base statistics, ``base_failed``, ``rule`` (0: none holds) and ``kept`` of every document, with ``row`` if it is to be kept.

    The statistics are computed and written once; rules are learned from those of the labelled documents and applied to all. Null
    texts have no words and fail. Null keys and documents without label are judged like others. Repeated rows are judged
    each. Texts of any length stay in their row. Extra columns stay in ``row`` and cannot clash. An empty table gives an empty result.
    """
    kept = ["row"] if keep else []
    found = written(statistics(docs, key, text).select(*kept, "key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                       "n_repeat_words", *FEATURES), "statistics")
    rules = learn(labelled(found, labels, key))
    return found.select(
        *kept, "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), verdict(rules).alias("rule"),
        (~base_failed() & (verdict(rules) == 0)).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    return judged(docs, labels, key, text).where("kept").select("row.*")
