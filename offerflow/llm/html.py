"""Main text of web pages: parse to blocks, and remove what a site style tree shows to be of low importance."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerflow.llm.common import written

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"))
NOT_TEXT = RAW | frozenset("head nav footer aside form button select menu dialog svg canvas object audio video".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()) | NOT_TEXT
NEUTRAL = frozenset("div section ul ol dl table figure details center header".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login search share sharing social related comment comments reply replies disqus respond toolbar "
    "pagination pager masthead".split())
#: Words that may stand beside a noise word in the name of the part itself; with others, the name speaks of the layout or the content.
BESIDE = frozenset(
    "area bar block body bottom box btn button buttons center col column container desktop fixed floating form global google group icon icons "
    "inner item items left link links list main mobile msg outer panel popular post posts primary right row secondary section site "
    "slot sticky text title top unit widget widgets wrap wrapper".split())
#: The share of its text that a page has in common with near copies.
NEAR = 0.75
#: A start tag of the first closes an open element of the second.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "body": ("head",), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody")}

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


def _hash(*parts: object) -> int:
    joined = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "little", signed=True)


class Element:
    """An open element: its name, whether its text counts, and its place in the style tree."""

    __slots__ = ("children", "main", "name", "named", "path", "places", "skipped")

    def __init__(self, name: str, path: int, places: tuple[int, ...], main: bool, skipped: bool, named: tuple[int, ...]) -> None:
        self.name, self.path, self.places, self.main, self.skipped, self.named = name, path, places, main, skipped, named
        self.children: list[int] = []


def _is_noise(name: str, attributes: dict[str, str], in_main: bool) -> bool:
    """Whether the element itself, or its role, says that it is no main text."""
    return name in NOT_TEXT or (name == "header" and not in_main) or attributes.get("role", "").lower() in ROLES


def _is_named(name: str, attributes: dict[str, str]) -> bool:
    """Whether a class or the id names a part such as a sidebar: ``sidebar``, ``left-sidebar``, but not ``has-sidebar``."""
    if name in ("html", "body", "article", "main") and "comment" not in attributes.get("class", ""):
        return False
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = {w.lower() for w in WORDS.findall(token) if len(w) > 1}
        if words & NOISE and words <= NOISE | BESIDE:
            return True
    return False


def _dropped(blocks: list[tuple[str, int, tuple[int, ...], bool, tuple[int, ...]]]) -> set[int]:
    """The named parts that go: those that hold neither most of the page's article nor, on a page without one, most of its text."""
    sizes: Counter[int] = Counter()
    article = any(main for *_, main, _ in blocks)
    whole = 0
    for text, _, _, main, named in blocks:
        if main or not article:
            whole += len(text)
            sizes.update(dict.fromkeys(named, len(text)))
    return {part for *_, named in blocks for part in named if 2 * sizes[part] <= whole}


def parse(page: str) -> tuple[list[tuple[str, int, list[int]]], list[tuple[int, int, int, int]]]:
    """Blocks (text, its hash, places) and style features (place, kind, value, count) of a page.

    A place is a neutral container: the hash of the names, classes and ids from the root to it; all containers of
    a page that look alike share one place. Kind 0 is the sequence of a container's children (its
    presentation), kind 1 a block of text anywhere inside it (its content). Parts dropped for their names are
    in neither; one that holds the article or most of the text is left to the tree.
    """
    stack, text, at, parts = [Element("", 0, (), False, False, ())], [], 0, 0
    blocks: list[tuple[str, int, tuple[int, ...], bool, tuple[int, ...]]] = []
    looks_of: list[tuple[int, int, tuple[int, ...]]] = []

    def flush() -> None:
        found = " ".join(unescape("".join(text)).split())
        text.clear()
        if found:
            top, value = stack[-1], _hash(found)
            blocks.append((found, value, top.places, top.main, top.named))

    def close(depth: int) -> None:
        if any(e.name in BLOCKS for e in stack[depth:]) or stack[-1].named != stack[depth - 1].named:
            flush()
        while len(stack) > depth:
            done = stack.pop()
            if done.places and done.name in NEUTRAL and not done.skipped:
                looks_of.append((done.places[-1], _hash(*done.children), done.named))

    def innermost(names: tuple[str, ...], walls: tuple[str, ...]) -> int:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                return depth
            if stack[depth].name in walls:
                return 0
        return 0

    def shown(piece: str) -> None:
        if piece and not stack[-1].skipped:
            text.append(piece)

    raw_end = None
    for found in MARKUP.finditer(page):
        if found.start() < at:
            continue
        shown(page[at:found.start()])
        at = found.end()
        closing, name, rest = found.group(1), (found.group(2) or "").lower(), found.group(3) or ""
        if not name:
            continue
        if name == "br" or (name in VOID and name not in BLOCKS):
            shown(" " if name == "br" else "")
            continue
        if closing:
            depth = innermost((name,), ())
            if depth:
                close(depth)
            continue
        if name in BLOCKS:
            opened = innermost(("p",), ("table", "td", "button"))
            if opened:
                close(opened)
            for other in CLOSES.get(name, ()):
                opened = innermost((other,), ("ul", "ol", "table", "dl") if name != "body" else ())
                if opened:
                    close(opened)
            flush()
        if name == "hr":
            continue
        top = stack[-1]
        attributes = {}
        if rest.strip() and (name in BLOCKS or "class" in rest or "role" in rest or "id" in rest):
            for a in ATTRIBUTE.finditer(rest):
                attributes.setdefault(a.group(1).lower(), unescape(a.group(2) or a.group(3) or a.group(4) or ""))
        noise = top.skipped or _is_noise(name, attributes, top.main)
        named = top.named
        if not noise and attributes and _is_named(name, attributes):
            parts += 1
            named = (*named, parts)
        main = top.main or (named == top.named and (name in ("article", "main") or attributes.get("role", "").lower() == "main"))
        path, places = top.path, top.places
        if name in BLOCKS:
            looks = _hash(name, attributes.get("class", ""), attributes.get("id", ""))
            top.children.append(looks)
            path = _hash(top.path, looks)
            places = (*top.places, path) if name in NEUTRAL else top.places
        if (noise and not top.skipped) or named != top.named:
            flush()
        if name in RAW:
            raw_end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = raw_end.end() if raw_end else len(page)
            continue
        if not rest.rstrip().endswith("/") or name in BLOCKS:
            stack.append(Element(name, path, places, main, noise, named))
    shown(page[at:])
    close(1)
    flush()
    gone = _dropped(blocks)
    kept = [b for b in blocks if gone.isdisjoint(b[-1])]
    features = Counter((place, 0, value) for place, value, named in looks_of if gone.isdisjoint(named))
    features.update((place, 1, value) for _, value, places, *_ in kept for place in set(places))
    return [(found, value, list(places)) for found, value, places, *_ in kept], [(*f, n) for f, n in features.items()]


_BLOCK = "array<struct<text:string,value:long,places:array<long>>>"
_FEATURE = "array<struct<place:long,kind:int,value:long,n:long>>"


def parsed(pages: DataFrame, columns: list[str], html: str) -> DataFrame:
    """The given columns, ``blocks`` and ``features`` of every page."""
    schema = pa.schema([
        ("blocks", pa.list_(pa.struct([("text", pa.string()), ("value", pa.int64()), ("places", pa.list_(pa.int64()))]))),
        ("features", pa.list_(pa.struct(
            [("place", pa.int64()), ("kind", pa.int32()), ("value", pa.int64()), ("n", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                found = [parse(t.as_py() or "") for t in part["_html"]]
                blocks = pa.array([[dict(zip(("text", "value", "places"), x, strict=True)) for x in b]
                                   for b, _ in found], schema.field(0).type)
                features = pa.array([[dict(zip(("place", "kind", "value", "n"), f, strict=True)) for f in fs]
                                     for _, fs in found], schema.field(1).type)
                kept = [part[c] for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, blocks, features], [*columns, "blocks", "features"])

    given = pages.select(*columns, F.col(html).alias("_html"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*columns).schema)
    return given.mapInArrow(run, f"{types}, blocks {_BLOCK}, features {_FEATURE}")


def independent(pages: DataFrame) -> DataFrame:
    """One page of each set of copies and near copies of a host: ``host``, ``look``, ``features``.

    ``pages``: ``host``, ``blocks``, ``features``. Pages whose blocks and features are all alike are copies. A page is a near copy if at least
    ``NEAR`` of its text lies in its core: blocks that other pages of the host have too, at least half as many pages as have the
    block in the middle of its text. Near copies whose cores have the same smallest hash count once, so a paragraph more
    or less, or another one, makes no page of its own. A page whose own text is more than the rest is no near copy, whatever
    the template repeats. Only hashes and lengths of blocks are shuffled, and no pages are compared in pairs.
    """
    sizes = F.array_distinct(F.transform("blocks", lambda b: F.struct(b["value"].alias("v"), F.length(b["text"]).cast("long").alias("n"))))
    look = F.xxhash64(F.sort_array("features"), F.transform("blocks", lambda b: b["value"])).alias("look")
    own = pages.where("host <> ''").select("host", sizes.alias("sizes"), look)
    looks = own.groupBy("host", "look").agg(F.min("sizes").alias("sizes"))
    texts = looks.select("host", "look", F.explode("sizes").alias("b")).select("host", "look", "b.*")
    common = texts.groupBy("host", "v").agg(F.count("*").alias("df")).where("df > 1")
    repeated = texts.join(common, ["host", "v"]).groupBy("host", "look").agg(
        F.array_sort(F.collect_list(F.struct("df", "n", "v"))).alias("r"))
    whole = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b["n"])
    given = looks.join(repeated, ["host", "look"]).select("host", "look", whole.alias("whole"), "r")
    once = F.col("whole") - F.aggregate("r", F.lit(0).cast("long"), lambda a, b: a + b["n"])
    middle = F.aggregate("r", F.struct(once.alias("at"), F.lit(1).cast("long").alias("df")), lambda a, b: F.struct(
        (a["at"] + b["n"]).alias("at"), F.when(2 * a["at"] < F.col("whole"), b["df"]).otherwise(a["df"]).alias("df")))
    core = given.select("host", "look", "whole", "r", middle["df"].alias("middle")).select(
        "host", "look", "whole", F.filter("r", lambda b: 2 * b["df"] >= F.col("middle")).alias("core"), "middle")
    held = F.aggregate("core", F.lit(0).cast("long"), lambda a, b: a + b["n"])
    near = core.where((F.col("middle") > 1) & (held >= NEAR * F.col("whole"))).select(
        "host", "look", F.array_min(F.transform("core", lambda b: b["v"])).alias("kind"))
    near = written(near.withColumn("first", F.min("look").over(Window.partitionBy("host", "kind"))).where("look <> first")
                   .select("host", "look"), "near-copies")
    found = pages.where("host <> ''").select("host", "features", look)
    return found.join(near, ["host", "look"], "left_anti").groupBy("host", "look").agg(F.any_value("features").alias("features"))


def style_tree(pages: DataFrame, least_pages: int = 4, damping: float = 0.9) -> DataFrame:
    """Importance of every place of every host: ``host``, ``place``, ``pages``, ``importance``, ``repeats``.

    ``pages``: ``host``, ``blocks``, ``features``. Copies and near copies of a page count once, so they say nothing
    about a site. With m pages that have the place, presentation importance is the entropy (base m) of its
    child sequences, and content importance one minus the mean entropy of its text blocks over pages, by
    occurrence: a block on every page has entropy 1, a block of one page 0. The composite weighs presentation
    by ``1 - damping ** children`` of the paper with one level for all content below. Places on
    fewer than ``least_pages`` pages tell too little and are left out. ``repeats`` are the hashes of the place's blocks
    found on two pages or more.
    """
    seen = independent(pages).select("host", "look", F.explode("features").alias("f")).select("host", "look", "f.*")
    per_page = seen.groupBy("host", "place").agg(F.countDistinct("look").alias("pages"))
    n = F.col("n").cast("double")
    values = seen.groupBy("host", "place", "kind", "value").agg(
        F.sum(n).alias("c"), F.sum(n * F.log(n)).alias("s"), F.count("*").alias("on"))
    sums = values.groupBy("host", "place").agg(*[F.sum(F.when(F.col("kind") == k, x).otherwise(0.0)).alias(name) for k, x, name in (
        (0, F.col("c"), "looks"), (0, F.col("c") * F.log("c"), "looks_log"),
        (1, F.col("c"), "texts"), (1, F.col("c") * F.log("c") - F.col("s"), "texts_log"))],
        F.collect_list(F.when((F.col("kind") == 1) & (F.col("on") > 1), F.col("value"))).alias("repeats"))
    tree = sums.join(per_page, ["host", "place"]).where(F.col("pages") >= least_pages)
    scale = F.log(F.col("pages").cast("double"))
    shape = F.when(F.col("looks") > 0, (F.log("looks") - F.col("looks_log") / F.col("looks")) / scale).otherwise(0.0)
    content = F.when(F.col("texts") > 0, 1 - F.col("texts_log") / F.col("texts") / scale).otherwise(0.0)
    return tree.select("host", "place", "pages", ((1 - damping) * shape + damping * content).alias("importance"), "repeats")


def main_text(pages: DataFrame, html: str = "html", url: str = "url", key: str = "page_id",
              threshold: float = 0.2, least_pages: int = 4) -> DataFrame:
    """``key``, ``url`` and ``text`` of every page: its main blocks in page order, joined by line feeds.

    Two kinds of evidence remove branches. The element says what it is (menus, headers and footers of the page, sidebars,
    forms, scripts, and classes, ids or roles that name notices, adverts or comments, unless a part so named holds the article
    or, on a page without one, most of the text); and the site's style
    tree says that a neutral container has importance below ``threshold``, since it looks and reads the same on the host's
    pages. Such a container goes from the pages where all its blocks are repeated ones; where it has a block of its own, it
    stays. Paragraphs and headings are never places of the tree, so an article keeps a passage that other
    pages share. Blocks outside an article or main element pass the same checks as those inside.

    Null and empty pages give an empty text. A null or odd URL has no host: such pages are read without a style tree. Very
    long pages are parsed in one pass. Repeated rows are extracted each. Null keys are kept. Other columns are
    ignored. An empty table gives an empty result.
    """
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))
    given = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), F.col(html).alias("html"))
    found = written(parsed(given, ["key", "url", "host"], "html"), "page-blocks")
    low = style_tree(found, least_pages).where(F.col("importance") < threshold)
    drops = written(low.groupBy("host").agg(F.collect_list(F.struct("place", "repeats")).alias("drops")), "low-importance")
    blocks = F.col("blocks")
    kept = F.filter(blocks, lambda b: ~F.coalesce(F.arrays_overlap(b["places"], F.col("gone")), F.lit(False)))
    text: Column = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    there = F.filter("drops", lambda d: F.array_contains(F.flatten(F.transform(blocks, lambda b: b["places"])), d["place"]))
    gone = F.transform(F.filter(there, lambda d: F.forall(blocks, lambda b: ~F.array_contains(b["places"], d["place"])
                                                          | F.array_contains(d["repeats"], b["value"]))), lambda d: d["place"])
    return found.join(drops, "host", "left").withColumn("gone", gone).select("key", "url", text.alias("text"))
