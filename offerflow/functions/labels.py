"""Keyword scores and the best-scoring label.

The rule tables enter the plan as one JSON literal each, which the optimizer folds into
a constant array; a few higher-order functions then walk it. Plans stay small however
many keywords there are, and the cost per text is that of the substring searches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also when ``body`` mentions it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def literal_array(values: Iterable[str]) -> Column:
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def literal_rows(rows: Iterable[dict], schema: str) -> Column:
    return F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")


def _hits(text: Column, words: Column) -> Column:
    return F.size(F.filter(words, lambda w: F.contains(text, w)))


def keyword_hits(text: Column, keywords: Iterable[str]) -> Column:
    """How many of the keywords occur in the text (as substrings)."""
    return let(text, lambda t: _hits(t, literal_array(keywords)))


def any_keyword(text: Column, keywords: Iterable[str]) -> Column:
    return let(text, lambda t: F.exists(literal_array(keywords), lambda w: F.contains(t, w)))


def best_label(text: Column, table: dict[str, tuple[str, ...]], minimum: int = 1) -> Column:
    """Label with most keyword hits, first declared on ties; NULL below the minimum."""
    rows = literal_rows(
        [{"rank": -i, "label": label, "words": words} for i, (label, words) in enumerate(table.items())],
        "rank int, label string, words array<string>")
    scored = let(text, lambda t: F.array_max(F.transform(rows, lambda r: F.struct(
        _hits(t, r["words"]).alias("hits"), r["rank"].alias("rank"), r["label"].alias("label")))))
    return let(scored, lambda s: F.when(s["hits"] >= minimum, s["label"]))


def first_label(text: Column, table: dict[str, tuple[str, ...]], minimum: int) -> Column:
    """First declared label with at least ``minimum`` keyword hits."""
    rows = literal_rows([{"label": k, "words": v} for k, v in table.items()], "label string, words array<string>")
    reached = let(text, lambda t: F.filter(rows, lambda r: _hits(t, r["words"]) >= minimum))
    return F.get(reached, F.lit(0))["label"]
