"""Skill extraction, ranking and categories.

Texts are normalised once; one automaton over all dictionary terms then finds, counts and places them in a single pass (see
``skill_index``). Only the named patterns stay regexes, on texts that hold one of their first tokens.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerflow import rules
from offerflow.functions.labels import let, literal_array
from offerflow.functions.skill_index import in_slices, scored_skills, terms_found
from offerflow.functions.text import NOT_AFTER_WORD, NOT_BEFORE_WORD, NOT_SPACE, lowered_text, strip

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LEFT, _RIGHT = "(?<![a-zA-Z0-9])", "(?![a-zA-Z0-9])"
_GAP = r"[\s\-]+"
#: Skills of a referential that a task may hold as an automaton.
MOST_TERMS = 100_000


_ASCII, _OTHER = r"[\x00-\x7F]+", r"[^\x00-\x7F]+"


@F.arrow_udf(T.StringType())
def _nfkd(texts: pa.Array) -> pa.Array:
    out = [pa.array([], pa.string())]
    for some in in_slices(texts):
        out.append(pa.array([None if t is None else unicodedata.normalize("NFKD", t) for t in some], pa.string()))
    return pa.concat_arrays(out)


def _decomposed(text: Column) -> Column:
    """NFKD of a text that is not pure ASCII, else NULL.

    ASCII characters decompose to themselves and no mark moves across one, so only the runs between them leave the JVM, as lines.
    """
    runs = _nfkd(F.when(text.rlike(_OTHER), F.regexp_replace(text, _ASCII, "\n")))
    # the plain parts and the runs take turns; a text that begins (ends) with ASCII has a blank run before (after) it
    plain = F.regexp_extract_all(text, F.lit(_ASCII), 0)
    turns = let(F.split(runs, "\n"), lambda r: F.zip_with(r, plain, lambda run, part: F.concat(run, F.coalesce(part, F.lit("")))))
    return F.array_join(turns, "")


def normalize_nfkd(text: Column) -> Column:
    """NFKD, special blanks to plain ones, lowercase; pure ASCII texts never leave the JVM.

    Blanks that stay special become tabs, so that ``\\s`` finds every blank.
    """
    decomposed = _decomposed(text)
    blanks = r"[[^ -~\xa1-\u167f]&&[\xa0\u200b\u202f\u2009\u2002\u2003]]"
    return lowered_text(F.regexp_replace(F.coalesce(decomposed, text), blanks, " "))


def skill_pattern(term: str) -> str:
    """Regex for a term: flexible gaps, no ASCII letter or digit on either side."""
    return f"{_LEFT}{_body(term)}{_RIGHT}"


def _body(term: str) -> str:
    return _GAP.join(re.escape(word) for word in term.split(" "))


def _any_of(terms: Iterable[str]) -> str:
    return f"{_LEFT}(?:{'|'.join(_body(t) for t in terms)}){_RIGHT}"


def _named(pattern: str) -> str:
    return f"(?=[a-z]){NOT_AFTER_WORD}{pattern}{NOT_BEFORE_WORD}"


def skill_dictionary(
    technical: dict[str, Iterable[str]] | None = None, soft: Iterable[str] | None = None,
) -> list[tuple[str, str, str, str]]:
    """Rows (term, display, kind, category) of all dictionary terms.

    Trigger phrases with accents are left out: texts are decomposed, so a
    composed accent in a phrase can never be found.
    """
    technical = rules.TECHNICAL_SKILLS if technical is None else technical
    soft = rules.SOFT_SKILLS if soft is None else soft
    terms = [(t.lower(), t.lower().title(), "technical", c) for c, ts in technical.items() for t in ts]
    terms += [(t.lower(), t.lower().title(), "soft", "soft_skills") for t in soft]
    return terms + [
        (t, label, "context", label) for label, ts in rules.CONTEXT_SKILLS.items() for t in ts
        if unicodedata.is_normalized("NFKD", t)
    ]


def _title(match: Column) -> Column:
    """Capitalise every word and keep the blanks between them."""
    return F.array_join(F.transform(F.regexp_extract_all(match, F.lit(r"\s+|\S+"), 0), F.initcap), "")


def pattern_skills(normalized: Column) -> Column:
    """Every match of the named patterns, capitalised.

    The cheapest test comes first: one of a pattern's first tokens somewhere, then as a whole token, then the pattern.
    """
    def matches(name: str, pattern: str) -> Column:
        heads = rules.NAMED_SKILL_HEADS[name]
        part = reduce(lambda a, b: a | b, [F.contains(normalized, F.lit(head)) for head in heads])
        whole = F.rlike(normalized, F.lit(_any_of(heads)))
        return F.when(part & whole, F.regexp_extract_all(normalized, F.lit(_named(pattern)), 0)).otherwise(
            F.array().cast("array<string>"))

    return F.transform(F.concat(*[matches(n, p) for n, p in rules.NAMED_SKILL_PATTERNS.items()]), _title)


def filter_skills(found: Column) -> Column:
    """Drop too short, too long and generic skills; ``found`` are structs with a field ``skill``."""
    low, high = rules.SKILL_LENGTHS
    generic = "|".join(rules.GENERIC_SKILL_TERMS)
    return F.filter(found, lambda s: F.length(s["skill"]).between(low, high) & ~F.lower(s["skill"]).rlike(generic))


def rank_skills(found: Column) -> Column:
    """Top skills as structs (skill, score), best first, then by name; skills that only their triggers show come last."""
    order = F.transform(found, lambda s: F.struct(
        (-F.coalesce(s["score"], F.lit(rules.CONTEXT_ONLY_SCORE))).alias("order"), s["skill"].alias("skill")))
    return F.transform(
        F.slice(F.array_sort(order), 1, rules.MAX_SKILLS),
        lambda r: F.struct(r["skill"].alias("skill"), (-r["order"]).alias("score")))


def with_skills(
    df: DataFrame, text: str, out: str = "skills", scores: str | None = None,
    technical: dict[str, Iterable[str]] | None = None, soft: Iterable[str] | None = None,
) -> DataFrame:
    """Append ``out``, the ranked skills of column ``text`` (empty for a blank text)."""
    keep = df.columns
    entries = tuple((term, shown) for term, shown, *_ in skill_dictionary(technical, soft))
    nothing = F.array().cast("array<string>")

    def with_extras(normalized: Column) -> Column:
        extras = F.transform(pattern_skills(normalized), strip)
        return F.struct(normalized.alias("text"), F.coalesce(extras, nothing).alias("extras"))

    normalized = F.when(F.col(text).rlike(NOT_SPACE), normalize_nfkd(F.col(text)))
    df = df.withColumn("_found", scored_skills(let(normalized, with_extras), entries))
    df = df.withColumn("_ranked", F.coalesce(rank_skills(filter_skills(F.col("_found"))),
                                             F.array().cast("array<struct<skill string, score double>>")))
    columns = [F.transform("_ranked", lambda r: r["skill"]).alias(out)]
    if scores:
        columns.append(F.col("_ranked").alias(scores))
    return df.select(*keep, *columns)


SKILL_KINDS = ("technical", "soft_skills", "languages", "certifications", "other")


def skill_kind(skill: Column) -> Column:
    """Kind of a single skill, first matching rule wins."""
    lowered = F.lower(skill)
    technical = [t for terms in rules.TECHNICAL_SKILLS.values() for t in terms]
    return (
        F.when(lowered.rlike(_any_of(technical)), "technical")
        .when(lowered.rlike(_any_of(rules.SOFT_SKILLS)), "soft_skills")
        .when(skill.rlike("(?iu)" + _named(rules.NAMED_SKILL_PATTERNS["spoken_languages"])), "languages")
        .when(skill.rlike("(?iu)" + _named(rules.NAMED_SKILL_PATTERNS["certifications"])), "certifications")
        .otherwise("other")
    )


def categorize_skills(skills: Column) -> Column:
    """Map from kind to the skills of that kind, in their given order."""
    kinded = F.transform(skills, lambda s: F.struct(skill_kind(s).alias("kind"), s.alias("skill")))

    def of_kind(kind: str) -> Column:
        return F.transform(F.filter(kinded, lambda p: p["kind"] == kind), lambda p: p["skill"])

    return F.map_from_arrays(literal_array(SKILL_KINDS), F.array(*[of_kind(k) for k in SKILL_KINDS]))


def match_skills(offers: DataFrame, key: str, text: str, referential: DataFrame, most: int = MOST_TERMS) -> DataFrame:
    """(key, skill, category, kind) for every skill of a referential table found in an offer.

    A referential of at most ``most`` skills becomes an automaton that every task builds, so a text is read where it
    lies and never moves. A larger one is matched by joins, with the same result.
    """
    columns = ["skill", "category", "kind"]
    skills = referential.where("skill IS NOT NULL").select(*columns, F.lower("skill").alias("term"))
    rows = skills.limit(most + 1).collect()
    if len(rows) > most:
        return _match_by_join(offers, key, text, skills)
    kept = T.StructType([referential.schema[c] for c in columns])
    if not rows:
        return offers.sparkSession.createDataFrame([], T.StructType([offers.schema[key], *kept.fields]))
    found = offers.select(key, terms_found(normalize_nfkd(F.col(text)), tuple(r["term"] for r in rows)).alias("_found"))
    found = found.select(key, F.explode_outer("_found").alias("_number")).where("_number IS NOT NULL")
    table = offers.sparkSession.createDataFrame(
        [(i, *(r[c] for c in columns)) for i, r in enumerate(rows)], T.StructType([T.StructField("_number", T.IntegerType()), *kept.fields]))
    return found.join(F.broadcast(table), "_number").select(key, *columns)


def _match_by_join(offers: DataFrame, key: str, text: str, skills: DataFrame) -> DataFrame:
    """Matches of a referential of any size.

    The tokens of a text meet the first tokens of the skills, and only those candidates
    meet the text again and are checked by regex. Skills without a letter or digit have the
    empty token, which every text has.
    """
    escaped = F.replace("term", F.lit(" "), F.lit("\\E" + _GAP + "\\Q"))
    dimension = skills.select(
        "skill", "category", "kind", F.regexp_extract("term", "[a-z0-9]+", 0).alias("_head"),
        F.concat(F.lit(f"{_LEFT}\\Q"), escaped, F.lit(f"\\E{_RIGHT}")).alias("_pattern"))
    texts = offers.select(key, normalize_nfkd(F.col(text)).alias("_norm"))
    tokens = texts.select(key, F.explode(
        F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all("_norm", F.lit("[a-z0-9]+"), 0)))).alias("_head"))
    candidates = tokens.join(dimension, "_head").drop("_head")
    return texts.join(candidates, key).where(F.rlike("_norm", F.col("_pattern"))) \
        .select(key, "skill", "category", "kind")
