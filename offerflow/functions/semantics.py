"""Sector, category, level, job type, experience and sentiment of an offer text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow import rules
from offerflow.functions.labels import best_label, let
from offerflow.functions.phrases import with_phrases
from offerflow.functions.text import NOT_AFTER_WORD, NOT_BEFORE_WORD, SPACE, to_number

_YEARS = "an(?:s|née|nées)?"
EXPERIENCE_PATTERNS = (
    rf"(?<![0-9])([0-9]++)\s*{_YEARS}\s*(?:d'expérience|expérience)",
    r"expérience\s*(?:de\s*)?([0-9]++)\s*an",
    r"(?<![0-9])([0-9]++)\+?\s*an",
)


def clean_offer_text(text: Column) -> Column:
    """Lowercase, collapse blanks, blank out special characters, trim."""
    collapsed = F.regexp_replace(F.lower(text), f"{SPACE}+", " ")
    return F.trim(F.regexp_replace(collapsed, r"""[^a-zA-ZÀ-ÿ0-9 \-'"]""", " "))


def experience_years(cleaned: Column) -> Column:
    """First match of each pattern in turn, accepted up to thirty years."""
    years = F.array(*[to_number(F.regexp_extract(cleaned, p, 1), "int") for p in EXPERIENCE_PATTERNS])
    return F.get(F.filter(years, lambda y: F.coalesce(y <= rules.MAX_EXPERIENCE_YEARS, F.lit(False))), F.lit(0))


def sector(cleaned: Column) -> Column:
    return best_label(cleaned, rules.SECTOR_KEYWORDS)


def job_category(cleaned: Column) -> Column:
    return best_label(cleaned, rules.CATEGORY_KEYWORDS)


def job_level(cleaned: Column) -> Column:
    return best_label(cleaned, rules.LEVEL_KEYWORDS)


def job_type(cleaned: Column) -> Column:
    return best_label(cleaned, rules.JOB_TYPE_KEYWORDS)


def sentiment(cleaned: Column) -> Column:
    """Positive minus negative words over two percent of all words, within -1..1."""
    lexicon = rules.POSITIVE_WORDS + rules.NEGATIVE_WORDS
    first_letters = "".join(sorted({w[0] for w in lexicon}))
    pattern = f"(?=[{first_letters}]){NOT_AFTER_WORD}(?:{'|'.join(lexicon)}){NOT_BEFORE_WORD}"
    # Cleaned texts hold no word characters besides these letters and digits.
    counts = F.struct(
        F.regexp_count(cleaned, F.lit("[a-z0-9À-ÖØ-öø-ÿ]+")).alias("words"),
        F.regexp_extract_all(cleaned, F.lit(pattern), 0).alias("marked"))

    def score(c: Column) -> Column:
        negative = F.size(F.filter(c["marked"], lambda w: w.isin(*rules.NEGATIVE_WORDS)))
        balance = F.size(c["marked"]) - F.lit(2) * negative
        share = balance / F.greatest(c["words"] * F.lit(rules.SENTIMENT_WORD_SHARE), F.lit(1.0))
        return F.when(c["words"] == 0, F.lit(0.0)).otherwise(
            F.bround(F.greatest(F.least(share, F.lit(1.0)), F.lit(-1.0)), 3))

    return let(counts, score)


def nlp_confidence(fields: list[Column], key_phrases: Column) -> Column:
    """Share of the seven facts that were found; the sentiment always is."""
    found = F.lit(1) + F.when(F.size(key_phrases) > 0, 1).otherwise(0)
    for field in fields:
        found = found + field.isNotNull().cast("int")
    return found / F.lit(rules.SEMANTIC_FIELD_COUNT)


def analyze_offer_text(df: DataFrame, text: str, key_phrases: bool = False, out: str = "nlp") -> DataFrame:
    """Append the struct ``out``, with key phrases if asked for; every field is NULL for an empty text."""
    keep = df.columns
    phrases = F.array().cast("array<string>")
    if key_phrases:
        df, phrases = with_phrases(df, text, "_phrases"), F.col("_phrases")
    cleaned = F.col("_clean")
    df = df.withColumn("_clean", F.when(F.col(text) != "", clean_offer_text(F.col(text))))
    df = df.withColumns({
        "_years": experience_years(cleaned), "_sector": sector(cleaned), "_category": job_category(cleaned),
        "_level": job_level(cleaned), "_type": job_type(cleaned), "_mood": sentiment(cleaned),
    })
    facts = [F.col(c) for c in ("_years", "_sector", "_category", "_level", "_type")]
    given = cleaned.isNotNull()
    return df.select(*keep, F.struct(
        facts[0].alias("experience_years"), facts[1].alias("sector"), facts[2].alias("job_category"),
        facts[3].alias("job_level"), facts[4].alias("job_type"), F.when(given, F.col("_mood")).alias("sentiment_score"),
        F.when(given, F.coalesce(phrases, F.array().cast("array<string>"))).alias("key_phrases"),
        F.when(given, nlp_confidence(facts, F.coalesce(phrases, F.array().cast("array<string>"))))
        .alias("confidence_score"),
    ).alias(out))
