"""Salary extraction: amounts, currency, period, monthly XOF and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow import rules
from offerflow.functions.text import lowered_text, to_number, truncate_text

# An amount takes its whole run of digits and blanks, and starts where that run starts; both
# keep the scan linear on long digit runs without changing which text is found.
_AMOUNT = r"([0-9][0-9\s]*+)"
_START = r"(?=[0-9])(?<![0-9]\s{0,9})"
_CURRENCY = rules.AMOUNT_CURRENCIES

RANGE_PATTERNS = (
    rf"{_START}{_AMOUNT}(?:à|a|to|-)\s*{_AMOUNT}{_CURRENCY}",
    rf"{_START}{_AMOUNT}-\s*{_AMOUNT}{_CURRENCY}",
    rf"entre\s+{_AMOUNT}(?:et|and)\s+{_AMOUNT}{_CURRENCY}",
    rf"de\s+{_AMOUNT}(?:à|a|to)\s+{_AMOUNT}{_CURRENCY}",
)
SINGLE_PATTERNS = (
    rf"{_START}{_AMOUNT}{_CURRENCY}",
    rf"{rules.SALARY_WORDS}\s+{_AMOUNT}",
)


def parse_amount(c: Column) -> Column:
    """Digits of the text as an amount; fewer than four digits are read as thousands."""
    number = to_number(F.regexp_replace(c, "[^0-9]", ""), "bigint")
    return F.when(number < 1000, number * 1000).otherwise(number)


def _amount_sql(column: str) -> str:
    digits = f"try_cast(nullif({column}, '') AS BIGINT)"
    return f"CASE WHEN {digits} < 1000 THEN {digits} * 1000 ELSE {digits} END"


def salary_currency(lowered: Column) -> Column:
    found = [F.when(lowered.rlike(p), F.lit(k)) for k, p in rules.CURRENCY_PATTERNS.items()]
    return F.coalesce(*found, F.lit(rules.DEFAULT_CURRENCY))


def salary_period(lowered: Column) -> Column:
    found = [F.when(lowered.rlike(p), F.lit(k)) for k, p in rules.PERIOD_PATTERNS.items()]
    return F.coalesce(*found, F.lit(rules.DEFAULT_PERIOD))


def monthly_xof_sql(amount: str, period: str, currency: str) -> str:
    """Monthly XOF value, truncated after each step; NULL when it leaves the 64-bit range."""
    monthly = (
        f"CASE {period} WHEN 'yearly' THEN try_cast({amount} / {rules.MONTHS_PER_YEAR}D AS BIGINT) "
        f"WHEN 'hourly' THEN try_multiply({amount}, {rules.HOURS_PER_MONTH}L) "
        f"WHEN 'daily' THEN try_multiply({amount}, {rules.DAYS_PER_MONTH}L) ELSE {amount} END"
    )
    return (
        f"CASE {currency} WHEN 'EUR' THEN try_cast(({monthly}) * {rules.EUR_TO_XOF}D AS BIGINT) "
        f"WHEN 'USD' THEN try_multiply({monthly}, {rules.USD_TO_XOF}L) "
        f"WHEN 'GBP' THEN try_multiply({monthly}, {rules.GBP_TO_XOF}L) ELSE {monthly} END"
    )


def salary_confidence(text: Column, minimum: Column) -> Column:
    """1.0 for a plausible monthly salary, 0.8 for an implausible one, 0.4 for defaults only."""
    low, high = rules.PLAUSIBLE_MONTHLY_XOF
    return (
        F.when(F.coalesce(text, F.lit("")) == "", F.lit(0.0))
        .when(minimum.isNull(), F.lit(0.4))
        .when(minimum.between(low, high), F.lit(1.0))
        .otherwise(F.lit(0.8))
    )


def find_amounts(df: DataFrame, lowered: str) -> DataFrame:
    """Add ``_lo`` and ``_hi``: the first accepted range, else the first non-zero single amount.

    Each pattern counts with its first match only; a range must be ordered and non-zero. Every
    range ends with an amount and a currency, so texts without that skip the range patterns.
    """
    text, ranges, singles = F.col(lowered), range(len(RANGE_PATTERNS)), range(len(SINGLE_PATTERNS))
    df = df.withColumns({f"_one{i}": F.regexp_extract(text, SINGLE_PATTERNS[i], 1) for i in singles})
    priced = F.col("_one0") != ""
    df = df.withColumns({f"_lo{i}": F.when(priced, F.regexp_extract(text, RANGE_PATTERNS[i], 1)) for i in ranges})
    df = df.withColumns({
        f"_hi{i}": F.when(F.col(f"_lo{i}") != "", F.regexp_extract(text, RANGE_PATTERNS[i], 2)) for i in ranges})
    found = [f"_{side}{i}" for i in ranges for side in ("lo", "hi")] + [f"_one{i}" for i in singles]
    df = df.withColumns({c: F.regexp_replace(c, r"\s+", "") for c in found})
    df = df.withColumns({c: F.expr(_amount_sql(c)) for c in found})

    def chosen(side: str) -> Column:
        accepted = " ".join(
            f"WHEN _lo{i} > 0 AND _hi{i} > 0 AND _lo{i} <= _hi{i} THEN _{side}{i}" for i in ranges)
        single = " ".join(f"WHEN _one{i} > 0 THEN _one{i}" for i in singles)
        return F.expr(f"CASE {accepted} {single} END")

    return df.withColumns({"_lo": chosen("lo"), "_hi": chosen("hi")}).drop(*found)


def with_salary(df: DataFrame, text: str, out: str = "salary_info", lowered: str | None = None) -> DataFrame:
    """Append the struct ``out`` with the salary read from column ``text``.

    ``lowered`` names a column that already holds the lowered text.
    """
    keep = df.columns
    if lowered is None:
        lowered = "_low"
        df = df.withColumn(lowered, lowered_text(F.col(text)))
    df = find_amounts(df, lowered).withColumns({
        "_cur": salary_currency(F.col(lowered)), "_per": salary_period(F.col(lowered))})
    df = df.withColumns({c: F.expr(monthly_xof_sql(c, "_per", "_cur")) for c in ("_lo", "_hi")})
    return df.select(*keep, F.struct(
        F.expr("_lo AS min_salary"),
        F.expr("_hi AS max_salary"),
        F.expr(f"CASE WHEN _lo IS NOT NULL THEN 'XOF' WHEN `{text}` <> '' THEN _cur END AS currency"),
        F.expr(f"CASE WHEN _lo IS NOT NULL THEN 'monthly' WHEN `{text}` <> '' THEN _per END AS period"),
        salary_confidence(F.col(text), F.col("_lo")).alias("confidence"),
        F.coalesce(truncate_text(F.col(text)), F.lit("")).alias("original_text"),
    ).alias(out))
