"""Contract classification and contract facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerflow import rules
from offerflow.functions.labels import any_keyword, best_label, first_label, keyword_hits, let, literal_rows
from offerflow.functions.text import lowered_text, to_number


def contract_score(lowered: Column) -> Column:
    return best_label(lowered, rules.CONTRACT_KEYWORDS)


def contract_infer(lowered: Column) -> Column:
    """Type suggested by at least two context hints, else the default type."""
    hinted = first_label(lowered, rules.CONTRACT_HINTS, rules.CONTRACT_HINTS_NEEDED)
    return F.coalesce(hinted, F.lit(rules.DEFAULT_CONTRACT))


def classify_lowered(lowered: Column) -> Column:
    """Contract type of a lowered text; NULL for an empty one."""
    return let(lowered, lambda t: F.when(t != "", F.coalesce(contract_score(t), contract_infer(t))))


def classify_contract(text: Column) -> Column:
    return classify_lowered(lowered_text(text))


def contract_duration_months(lowered: Column) -> Column:
    """``N m…`` as months, else ``N a…``/``N year`` as years."""
    def number(unit: str) -> Column:
        return to_number(F.regexp_extract(lowered, rf"(?<![0-9])([0-9]++)\s*+{unit}", 1), "bigint")

    return F.coalesce(number("m"), F.try_multiply(number("(?:a|year)"), F.lit(rules.MONTHS_PER_YEAR)))


def is_remote(lowered: Column) -> Column:
    return any_keyword(lowered, rules.REMOTE_WORDS)


def is_full_time(lowered: Column) -> Column:
    return keyword_hits(lowered, rules.FULL_TIME_WORDS) >= keyword_hits(lowered, rules.PART_TIME_WORDS)


def contract_confidence(contract_type: Column, duration: Column, remote: Column) -> Column:
    def bonus(flag: Column, value: float) -> Column:
        return F.when(flag, F.lit(value)).otherwise(F.lit(0.0))

    total = (
        bonus(F.coalesce(contract_type, F.lit("")) != "", 0.4)
        + bonus(F.coalesce(duration, F.lit(0)) != 0, 0.2)
        + bonus(remote, 0.2)
        + F.lit(0.2)
    )
    return F.least(total, F.lit(1.0))


def extract_contract_info(text: Column) -> Column:
    """All contract facts as a struct; an empty text yields the defaults."""
    def facts(t: Column) -> Column:
        found = F.struct(
            classify_lowered(t).alias("kind"), contract_duration_months(t).alias("months"),
            is_remote(t).alias("remote"), is_full_time(t).alias("full_time"))
        return let(found, lambda f: F.struct(
            F.when(t != "", f["kind"]).alias("contract_type"),
            F.when(t != "", f["months"]).alias("duration_months"),
            F.coalesce((t != "") & f["remote"], F.lit(False)).alias("is_remote"),
            F.when(t != "", f["full_time"]).otherwise(F.lit(True)).alias("is_full_time"),
            F.when(t != "", contract_confidence(f["kind"], f["months"], f["remote"])).otherwise(F.lit(0.0))
            .alias("confidence")))

    return let(lowered_text(text), facts)


def _reference_salary(minimum: Column, maximum: Column) -> Column:
    """Half of the minimum, or of the maximum when there is no minimum."""
    return F.coalesce(F.nullif(minimum, F.lit(0)), F.nullif(maximum, F.lit(0))) / F.lit(2.0)


def _salary_ranges() -> Column:
    return literal_rows(
        [{"label": k, "low": low, "high": high} for k, (low, high) in rules.CONTRACT_SALARY_RANGES.items()],
        "label string, low bigint, high bigint")


def recommend_contracts(minimum: Column, maximum: Column) -> Column:
    """First contract types whose salary range holds the reference salary."""
    fitting = let(_reference_salary(minimum, maximum), lambda s: F.filter(
        _salary_ranges(), lambda r: F.coalesce(s.between(r["low"], r["high"]), F.lit(False))))
    return F.slice(F.transform(fitting, lambda r: r["label"]), 1, rules.MAX_CONTRACT_RECOMMENDATIONS)


def validate_contract_salary(contract_type: Column, minimum: Column, maximum: Column) -> Column:
    """False only when a known type's salary range does not hold the reference salary."""
    outside = let(F.struct(contract_type.alias("kind"), _reference_salary(minimum, maximum).alias("salary")), lambda x: F.exists(
        _salary_ranges(), lambda r: F.coalesce(
            (r["label"] == x["kind"]) & ~x["salary"].between(r["low"], r["high"]), F.lit(False))))
    return ~outside
