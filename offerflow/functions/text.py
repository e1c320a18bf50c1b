"""Cleaning expressions: Column in, Column out, all evaluated in the JVM.

Regex conventions: ``SPACE`` lists all Unicode blanks, digits are ASCII, and "word"
characters are letters, numbers and the underscore, without the combining marks that
Java adds to ``\\w``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = r"\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Classes are tested from left to right, so the first part decides about most characters.
SPACE = rf"[[^!-~\xa1-\u167f]&&[\s{_BLANKS}]]"
SPECIAL_BLANK = rf"[[^ -~\xa1-\u167f]&&[{_BLANKS}]]"
NOT_SPACE = rf"[!-~\xa1-\u167f[^\s{_BLANKS}]]"
WORD = r"a-zA-Z0-9\p{L}\p{N}_"
NOT_AFTER_WORD = rf"(?<![{WORD}])"
NOT_BEFORE_WORD = rf"(?![{WORD}])"


def strip(c: Column) -> Column:
    """Trim Unicode whitespace on both ends (SQL ``trim`` only removes blanks)."""
    return F.regexp_replace(c, rf"^{SPACE}++|{SPACE}(?<!{SPACE}{SPACE}){SPACE}*+\z", "")


def lowered_text(c: Column) -> Column:
    """Lowercase, with every special blank as a tab: ``\\s`` then finds all blanks at ASCII cost."""
    return F.regexp_replace(F.lower(c), SPECIAL_BLANK, "\t")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def to_number(c: Column, kind: str) -> Column:
    """Number in a text. An empty text is NULL at once; a failing cast would raise and catch per row."""
    return empty_to_null(c).try_cast(kind)


def first_raw(values: Column) -> Column:
    """First element of a list-valued field as it is."""
    return F.get(values, F.lit(0))


def first_text(values: Column) -> Column:
    """First element of a list-valued field, trimmed; NULL for an empty list."""
    return strip(first_raw(values))


def scalar_text(c: Column) -> Column:
    """Trimmed text of a scalar field; NULL for an empty one."""
    return F.when(c != "", strip(c))


def digits_to_int(c: Column) -> Column:
    """All digits of the text as one integer."""
    return to_number(F.regexp_replace(c, "[^0-9]", ""), "bigint")


def first_number(c: Column) -> Column:
    """First decimal number, after removing blanks and narrow no-break spaces."""
    return to_number(F.regexp_extract(F.translate(c, "\u202f ", ""), r"([0-9]+(?:\.[0-9]+)?)", 1), "double")


def _strip_ends(c: Column) -> Column:
    """The same for a value that costs nothing to repeat: only a text with a blank at an end is searched."""
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    return F.when(F.rlike(ends, F.lit(SPACE)), strip(c)).otherwise(c)


def fragments(values: Column) -> Column:
    """Trimmed, non-blank elements of a list of text fragments."""
    return F.filter(F.transform(values, _strip_ends), lambda x: x != "")


def join_fragments(values: Column, separator: str) -> Column:
    return F.array_join(fragments(values), separator)


def collapse_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def strip_colon(c: Column) -> Column:
    """Label values such as ``"Région : Dakar"``: drop colons, then collapse blanks."""
    return collapse_ws(F.replace(c, F.lit(":"), F.lit("")))


def clean_label(c: Column) -> Column:
    """Trim, collapse blanks and drop everything but words, blanks, ``&``, ``'`` and ``-``."""
    return F.regexp_replace(collapse_ws(c), rf"[^{WORD} À-ÿ&'-]", "")


def labels_to_json(values: Column) -> Column:
    """JSON array text of the non-blank labels, with accents kept and ``", "`` between items."""
    quoted = F.transform(fragments(values), lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", ""))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def url_id(url: Column) -> Column:
    return F.md5(url)


def first_match(values: Column, pattern: str) -> Column:
    """First fragment in which ``pattern`` is found."""
    return F.get(F.filter(fragments(values), lambda x: x.rlike(pattern)), F.lit(0))


def iso_date_fragment(values: Column) -> Column:
    return first_match(values, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}")


def salary_fragment(values: Column) -> Column:
    return first_match(values, r"(?iu)mois")


def nth_fragment(values: Column, index: int) -> Column:
    """Trimmed n-th raw fragment, blank ones counted."""
    return strip(F.get(values, F.lit(index)))


def first_digits(c: Column) -> Column:
    """First run of digits (the reference number of an ad)."""
    return empty_to_null(F.regexp_extract(c, "[0-9]+", 0))


def company_from_title(title: Column) -> Column:
    """Company named before "recrute", "recherche" or "recrutement" in a title."""
    found = F.regexp_extract(title, r"(?iuU)^([^-]+?)\s+(?:recrute|recherche|recrutement)", 1)
    return empty_to_null(strip(found))


def property_value(pairs: Column, label: str) -> Column:
    """Value of the first (dt, dd) pair whose label contains ``label``."""
    hits = F.filter(pairs, lambda p: F.contains(p["dt"], F.lit(label)) & (F.coalesce(p["dd"], F.lit("")) != ""))
    return F.get(hits, F.lit(0))["dd"]


def coalesce_description(paragraphs: Column, lists: Column) -> Column:
    return F.coalesce(paragraphs, lists, F.lit(""))


def offer_text(title: Column, description: Column) -> Column:
    """Title and description as one text; missing parts are skipped."""
    return F.concat_ws(" ", title, description)


def model_text(title: Column, description: Column, default: str) -> Column:
    """Offer text for the classifier, never empty."""
    text = offer_text(title, description)
    return F.when(text == "", F.lit(default)).otherwise(text)


def truncate_text(c: Column, size: int = 200) -> Column:
    """Short display form of a text (the full text is what gets analysed)."""
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit("..."))).otherwise(c)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of a link found on page ``base``."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/(?:[^?#]*/)?)", 1)
    folder = F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder)
    link = strip(href)
    return (
        F.when(link == "", base)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(page, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .otherwise(F.concat(folder, link))
    )


def is_detail_link(href: Column) -> Column:
    """Listing links that lead to an offer, not to another listing page."""
    return (F.coalesce(href, F.lit("")) != "") & ~F.contains(href, F.lit("page="))
