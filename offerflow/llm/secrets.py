"""Secret scans by a trigram inverted index with exact verification. DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow.llm.common import written

#: Strings that a part of a pattern is expanded to at most; beyond it, the part adds no trigrams.
EXPANDED = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and the least length of one of its groups; shorter matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, in the order of report, and common public key formats. A run of
# 24 or more hexadecimal digits is the same as a longest run that is then found to have 24.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]+@"),
)
BASE = 3

#: A clause is a list of alternatives, an alternative a set of trigrams; a query is a list of clauses that all must hold.
Clause = list[frozenset[str]]


def _strings(items) -> set[str] | None:
    """All lower-case strings a parsed pattern matches, if there are few."""
    found = {""}
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            parts = {chr(arg).lower()}
        elif name == "IN":
            parts = set()
            for kind, value in arg:
                if str(kind) == "LITERAL":
                    parts.add(chr(value).lower())
                elif str(kind) == "RANGE" and value[1] - value[0] < EXPANDED:
                    parts.update(chr(c).lower() for c in range(value[0], value[1] + 1))
                else:
                    return None
        elif name == "SUBPATTERN":
            parts = _strings(arg[3])
        elif name == "BRANCH":
            several = [_strings(a) for a in arg[1]]
            parts = None if None in several else set().union(*several)
        elif name == "MAX_REPEAT" and int(arg[1]) <= 3:
            once = _strings(arg[2])
            parts = None if once is None or len(once) ** int(arg[1]) > EXPANDED else {
                "".join(p) for n in range(int(arg[0]), int(arg[1]) + 1) for p in product(once, repeat=n)}
        elif name == "AT":
            parts = {""}
        else:
            return None
        if parts is None or len(found) * len(parts) > EXPANDED:
            return None
        found = {a + b for a in found for b in parts}
    return found


def _clauses(items) -> list[Clause]:
    query, runs = [], {""}

    def flush() -> None:
        nonlocal runs
        if all(len(s) >= 3 for s in runs):
            options = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in runs}
            query.append(sorted((o for o in options if not any(p < o for p in options)), key=sorted))
        runs = {""}

    for item in items:
        parts = _strings([item])
        if parts is not None and len(runs) * len(parts) <= EXPANDED:
            runs = {a + b for a in runs for b in parts}
            continue
        flush()
        name, arg = str(item[0]), item[1]
        if parts is not None:
            runs = parts
        elif name == "SUBPATTERN":
            query += _clauses(arg[3])
        elif name == "MAX_REPEAT" and int(arg[0]) >= 1:
            query += _clauses(arg[2])
        elif name == "BRANCH":
            several = [_clauses(a) for a in arg[1]]
            if all(several):
                query.append([a for clauses in several for a in clauses[0]])
    flush()
    return query


def trigram_query(pattern: str) -> list[Clause]:
    """The Boolean trigram query that every lower-case text with a match satisfies; empty if no trigram is mandatory."""
    return _clauses(re._parser.parse(pattern))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``doc`` (hash) and ``kinds``: which rules' trigram queries hold. ``docs``: ``doc``, ``text``.

    The index posts a document under each trigram that some query names. A rule's clauses are matched to the
    postings by trigram, and the postings of an alternative, the alternatives of a clause and
    the clauses of a rule are put together by bit masks, which combine before the shuffle.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = sorted({t for q in queries.values() for clause in q for option in clause for t in option})
    wanted = [(asked.index(t), kind, 1 << c, a, 1 << i, (1 << len(option)) - 1, (1 << len(q)) - 1)
              for kind, q in queries.items() for c, clause in enumerate(q) for a, option in enumerate(clause)
              for i, t in enumerate(sorted(option))]
    spark = docs.sparkSession
    terms = F.broadcast(spark.createDataFrame(  # as many rows as the rules have trigrams
        wanted, "trigram int, kind string, clause long, option int, bit long, all_bits long, all_clauses long"))
    lowered = docs.select("doc", F.lower("text").alias("low"))
    present = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(asked)])
    postings = lowered.select("doc", F.explode(F.array_compact(present)).alias("trigram"))
    options = postings.join(terms, "trigram").groupBy("doc", "kind", "clause", "option", "all_bits", "all_clauses") \
        .agg(F.bit_or("bit").alias("bits")).where("bits = all_bits")
    kinds = options.groupBy("doc", "kind", "all_clauses").agg(
        F.bit_or("clause").alias("clauses")).where("clauses = all_clauses")
    return kinds.groupBy("doc").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Leftmost matches that do not overlap, as sorted structs; positions are code points, end exclusive.

    The text split at the pattern gives what lies between matches, so lengths add up to places.
    """
    between = F.split(text, rule.pattern, -1)
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("m"),
                         F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("g"))
    empty = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(F.element_at(between, state["n"]))
        end = start + F.length(pair["m"])
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"),
                                end.alias("end")))
        kept = F.when(F.length(pair["g"]) >= rule.least, F.concat(state["found"], span)).otherwise(state["found"])
        return F.struct(end.alias("at"), (state["n"] + 1).alias("n"), kept.alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.lit(1).alias("n"), empty.alias("found"))
    return F.aggregate(pairs, start, step, lambda s: s["found"])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the document's columns as a struct) and ``spans``, sorted by start, then by the order of the rules.

    A rule with mandatory trigrams is verified on the texts that the index gives for it, the others on all texts.
    Documents meet their candidate rules by a hash of key and text; should hashes collide, a
    text is verified for nothing. Null texts are empty and have no span. Repeated rows are scanned each. Null
    keys are kept. Extra columns stay in ``row`` and cannot clash. An empty table gives an empty result.
    """
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.xxhash64(F.col(key), F.col(text)).alias("doc"))
    found = written(candidates(rows.select("doc", "text"), rules), "secret-candidates")
    named = rows.join(found, "doc", "left")
    spans = []
    for order, rule in enumerate(rules):
        given = _spans(F.col("text"), rule, order)
        if trigram_query(rule.pattern):
            asked = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
            given = F.when(asked, given).otherwise(F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>"))
        spans.append(given)
    found = named.select("row", F.struct(F.sort_array(F.concat(*spans)).alias("spans")).alias("found"))
    return found.select("row", F.inline(F.array("found")))  # a later filter does not scan again


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text",
             mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; overlapping spans give one mark. Others are unchanged.

    Columns and their order stay. Null texts stay null.
    """
    value = F.col("row").getField(text)

    def step(state: Column, span: Column) -> Column:
        before = F.substring(value, state["at"] + 1, span["start"] - state["at"])
        out = F.when(span["start"] >= state["at"], F.concat(state["out"], before, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("spans", start, step,
                        lambda s: F.concat(s["out"], F.substring(value, s["at"] + 1, F.length(value))))
    found = find_secrets(docs, rules, key, text)
    shown = F.when(F.size("spans") > 0, clean).otherwise(value)
    return found.select(*[(shown if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])
