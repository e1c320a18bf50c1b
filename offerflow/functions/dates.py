"""French posting dates relative to an explicit ``as_of`` moment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerflow import rules
from offerflow.functions.text import NOT_AFTER_WORD, NOT_BEFORE_WORD, strip, to_number

NTZ = "timestamp_ntz"
# Largest shifts that stay inside the calendar; larger ones give NULL.
_MAX_SHIFT = {"mins": 1_000_000_000, "hours": 16_800_000, "days": 700_000}


def moment(as_of: str) -> Column:
    return F.lit(as_of).cast(NTZ)


def day(as_of: str) -> Column:
    return F.lit(as_of[:10]).cast("date")


def _group_int(c: Column, pattern: str, group: int = 1) -> Column:
    return to_number(F.regexp_extract(c, pattern, group), "int")


def _shift(start: Column, unit: str, count: Column) -> Column:
    return start - F.make_dt_interval(**{unit: F.when(count <= _MAX_SHIFT[unit], count)})


def _month_number(names: dict[str, int], name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.try_element_at(table, name)


def _date_at(year: Column, month: Column, day_of_month: Column) -> Column:
    return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month, day_of_month).try_cast("date").cast(NTZ)


def parse_iso_date(c: Column) -> Column:
    """``YYYY-M-D`` only, else NULL."""
    text = strip(c)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), text).try_cast("date")


def parse_posted_fr(c: Column, as_of: str) -> Column:
    """Posting date of a cleaned label: ISO, time of today, "il y a N jours", "hier", "30. août"."""
    text, now = F.lower(strip(c)), moment(as_of)
    clock = rf"{NOT_AFTER_WORD}([0-9]{{1,2}})[:h]?([0-9]{{2}})?{NOT_BEFORE_WORD}"
    hour = _group_int(text, clock)
    minute = F.coalesce(_group_int(text, clock, 2), F.lit(0))
    today_at = F.when(
        hour.between(0, 23) & minute.between(0, 59),
        day(as_of).cast(NTZ) + F.make_dt_interval(hours=hour, mins=minute),
    )
    named = r"^([0-9]{1,2})\.\s*([a-zéû]+)"
    month = _month_number(rules.MONTHS_SHORT_FR, F.substring(F.regexp_extract(text, named, 2), 1, 4))
    return F.coalesce(
        parse_iso_date(text).cast(NTZ),
        today_at,
        _shift(now, "days", _group_int(text, r"il y a ([0-9]+) jours?")),
        F.when(F.contains(text, F.lit("hier")), now - F.make_dt_interval(days=F.lit(1))),
        F.when(month.isNotNull(), _date_at(F.lit(int(as_of[:4])), month, F.regexp_extract(text, named, 1))),
    )


def parse_relative_fr(c: Column, as_of: str) -> Column:
    """"depuis 18 minutes", "3 heures", "2 jours", "hier", "aujourd'hui" or ``D month YYYY``."""
    text, now = F.lower(strip(c)), moment(as_of)
    absolute = r"(?U)^([0-9]{1,2})\s+(\p{L}+)\s+([0-9]{4})\z"
    month = _month_number(rules.MONTHS_LONG, F.regexp_extract(text, absolute, 2))
    return F.coalesce(
        _shift(now, "mins", _group_int(text, r"(?U)([0-9]++)\s+min")),
        _shift(now, "hours", _group_int(text, r"(?U)([0-9]++)\s+h")),
        _shift(now, "days", _group_int(text, r"(?U)([0-9]++)\s+j")),
        F.when(F.contains(text, F.lit("hier")), now - F.make_dt_interval(days=F.lit(1))),
        F.when(F.contains(text, F.lit("aujourd'hui")), now),
        F.when(month.isNotNull(), _date_at(
            F.regexp_extract(text, absolute, 3), month, F.regexp_extract(text, absolute, 1))),
    )
