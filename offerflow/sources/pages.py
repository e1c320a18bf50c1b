"""Web pages to rows: fields, listing links and link fragments inside JSON.

Spark has no HTML function, so this is the one place where Python reads records: an
Arrow batch function parses each page with the standard library and returns, per
page or per block, a map from field to list of strings. All cleaning, typing and
joining of those lists happens in Spark expressions.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow.functions import text as tx
from offerflow.functions.dates import moment, parse_iso_date, parse_posted_fr, parse_relative_fr
from offerflow.sources import site_rules

# The parser travels with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pages of an Arrow batch, which holds up to thousands, that are parsed and given on at a time.
PAGES_AT_ONCE = 64

_VOID = set("area base br col embed hr img input link meta source track wbr".split())
# A start tag closes an open element of the same group, up to the group's container.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
_CONTAINERS = {"ul", "ol", "dl", "table", "select", "div", "body", "article", "section", "nav"}
_CLOSES_P = set("address article blockquote div dl footer form h1 h2 h3 h4 h5 h6 header hr nav ol p pre section "
                "table ul".split())


class _Node:
    def __init__(self, tag: str, attrs: dict[str, str], parent: _Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[_Node | str] = []
        # Place among the siblings of the same tag, next element, last child element: set while the tree grows.
        self.turn, self.next, self.last, self.tags = 0, None, None, {}
        # Place in the document, end of the elements below, index of the whole tree: set by ``_indexed``.
        self.start, self.end, self.index = 0, 0, None

    def add(self, node: _Node) -> None:
        node.turn = self.tags[node.tag] = self.tags.get(node.tag, 0) + 1
        if self.last is not None:
            self.last.next = node
        self.last = node
        self.children.append(node)

    def elements(self) -> list[_Node]:
        return [c for c in self.children if isinstance(c, _Node)]

    def found(self, key: str) -> list[_Node]:
        """Elements below with a tag, ``.class`` or ``#id``, or all of them (empty key), in document order."""
        places, nodes = (self.index or _indexed(self)).get(key, ((), ()))
        return nodes[bisect_right(places, self.start):bisect_right(places, self.end)]

    def texts(self, own: bool = True, deep: bool = True) -> Iterator[str]:
        stack: list[tuple[_Node | str, bool]] = [(c, own) for c in self.children[::-1]]
        while stack:
            child, wanted = stack.pop()
            if isinstance(child, str):
                if wanted:
                    yield child
            elif deep:
                stack.extend((c, True) for c in child.children[::-1])


def _indexed(node: _Node) -> dict[str, tuple[list[int], list[_Node]]]:
    """The elements of the whole tree by tag, class and id, each with its place; made once for all selectors of a page."""
    while node.parent is not None:
        node = node.parent
    index: dict[str, tuple[list[int], list[_Node]]] = {}
    place, stack = 0, [node]
    while stack:
        node = stack.pop()
        if node.index is not None:  # all elements below have their places
            node.end = place
            continue
        place += 1
        node.start, node.index = place, index
        keys = {"", node.tag, *(f".{c}" for c in node.attrs.get("class", "").split())}
        if "id" in node.attrs:
            keys.add(f"#{node.attrs['id']}")
        for key in keys:
            places, nodes = index.setdefault(key, ([], []))
            places.append(place)
            nodes.append(node)
        stack.append(node)
        stack.extend(node.elements()[::-1])
    return index


class _Tree(HTMLParser):
    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.open = _Node("#root", {}, None)
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self._close_implied(tag)
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.add(node)
        if tag not in _VOID:
            self.open = node

    def _close_implied(self, tag):
        ends = _CLOSES.get(tag, set()) | ({"p"} if tag in _CLOSES_P else set())
        node = self.open
        while node.parent is not None and node.tag not in _CONTAINERS:
            if node.tag in ends:
                self.open = node.parent
            node = node.parent

    def handle_endtag(self, tag):
        node = self.open
        while node.parent is not None:
            if node.tag == tag:
                self.open = node.parent
                return
            node = node.parent

    def handle_data(self, data):
        self.open.children.append(data)


_STEP = re.compile(r"""^([a-z0-9*]*)((?:[.#][\w-]+|\[[^\]]+\]|:[a-z-]+(?:\(\d+\))?)*)$""")


@lru_cache(maxsize=None)
def _compiled(step: str) -> tuple[str, str, list[Callable[[_Node], bool]]]:
    """Key of the index that has the fewest elements for a step, its tag and its other tests; the steps are those of the site rules."""
    tag, rest = _STEP.match(step).groups()
    tag = "" if tag == "*" else tag
    parts = re.findall(r"[.#][\w-]+|\[[^\]]+\]|:[a-z-]+(?:\(\d+\))?", rest)
    key = next((p for sign in "#." for p in parts if p[0] == sign), tag)
    return key, tag, [_test(part) for part in parts if part != key]


def _test(part: str) -> Callable[[_Node], bool]:
    if part[0] == ".":
        return lambda n: part[1:] in n.attrs.get("class", "").split()
    if part[0] == "#":
        return lambda n: part[1:] == n.attrs.get("id")
    if part == ":last-child":
        return lambda n: n.parent.last is n
    nth = re.match(r":nth-of-type\((\d+)\)", part)
    if nth:
        return lambda n: n.turn == int(nth.group(1))
    name, operator, value = re.match(r'\[([\w-]+)(\*?=)"([^"]*)"\]', part).groups()
    if operator == "*=":
        return lambda n: value in n.attrs.get(name, "") if name in n.attrs else False
    return lambda n: n.attrs.get(name) == value


def _select(root: _Node, path: str) -> list[_Node]:
    """Elements below ``root`` on a path of descendant steps, in document order."""
    nodes = [root]
    for step in path.split():
        found: dict[int, _Node] = {}
        for node in nodes:
            if step.startswith("<"):
                candidates = [node.parent] if node.parent.tag == step[1:] else []
            elif step.startswith("+"):
                after = node.next
                while after is not None and after.tag != step[1:]:
                    after = after.next
                candidates = [after] if after is not None else []
            else:
                key, tag, tests = _compiled(step)
                candidates = [e for e in node.found(key) if tag in ("", e.tag) and all(test(e) for test in tests)]
            for candidate in candidates:
                found.setdefault(id(candidate), candidate)
        nodes = list(found.values())
    return nodes


def _values(root: _Node, rule: str) -> list[str]:
    path, _, what = rule.rpartition("::")
    if what.startswith("attr("):
        nodes = _select(root, path)
        return [n.attrs[what[5:-1]] for n in nodes if what[5:-1] in n.attrs]
    if what == "first":  # one entry per starting element, blank if it has none
        start, _, last = path.rpartition(" ")
        return [next((t for n in _select(s, last) for t in n.texts(deep=False)), "") for s in _select(root, start)]
    if what == "joined":
        return ["".join(n.texts()) if path.startswith("dt") else " ".join(n.texts()).strip()
                for n in _select(root, path)]
    if path.endswith("*"):
        texts = (n.texts(own=False) for n in _outermost(_select(root, path[:-1])))
    else:
        nodes = _select(root, path)
        deep = path.endswith(" ")
        texts = (n.texts(deep=deep) for n in (_outermost(nodes) if deep else nodes))
    return [t for group in texts for t in group]


def _outermost(nodes: list[_Node]) -> list[_Node]:
    """Without those inside another one, whose texts the outer one already yields."""
    chosen = {id(n) for n in nodes}

    def nested(node: _Node) -> bool:
        while node.parent is not None:
            node = node.parent
            if id(node) in chosen:
                return True
        return False

    return [n for n in nodes if not nested(n)]


_FIELDS = "map<string, array<string>>"
_ARROW_FIELDS = pa.map_(pa.string(), pa.list_(pa.string()))


def _fields_array(fields: list[dict[str, list[str]]]) -> pa.Array:
    return pa.array([list(f.items()) for f in fields], _ARROW_FIELDS)


def _slices(batches: Iterator[pa.RecordBatch], html: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The other columns and the pages of a few rows at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, PAGES_AT_ONCE):
            some = batch.slice(low, PAGES_AT_ONCE)
            yield some.drop_columns([html]), [h or "" for h in some.column(html).to_pylist()]


def extract_fields(pages: DataFrame, rules: dict[str, str], html: str = "html") -> DataFrame:
    """Pages with the map ``fields``; the HTML itself is dropped."""
    keep = [f for f in pages.schema if f.name != html]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [f"fields {_FIELDS}"])

    def of_page(text: str) -> dict[str, list[str]]:
        root = _Tree(text).root
        return {name: _values(root, rule) for name, rule in rules.items()}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rest, texts in _slices(batches, html):
            fields = _fields_array([of_page(t) for t in texts])
            yield pa.RecordBatch.from_arrays([*rest.columns, fields], [*rest.schema.names, "fields"])

    return pages.mapInArrow(parse, schema)


def extract_blocks(pages: DataFrame, listing: dict, url: str = "url", html: str = "html") -> DataFrame:
    """One row per listed offer (``kind='detail'``) and per next-page link (``kind='next'``).

    ``link`` is absolute, ``fields`` holds the other values of the block.
    """
    keep = [f for f in pages.schema if f.name != html]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep]
                       + ["position int", "kind string", "link string", f"fields {_FIELDS}"])

    def of_page(text: str, base: str) -> Iterator[tuple[int, str, str | None, dict[str, list[str]]]]:
        root = _Tree(text).root
        for position, block in enumerate(_select(root, listing["block"])):
            values = {name: _values(block, rule) for name, rule in listing["fields"].items()}
            link = next(iter(values["link"]), None)
            yield position, "detail", urljoin(base, link.strip()) if link else None, values
        for link in _values(root, listing["next"])[:1] if listing["next"] else []:
            yield -1, "next", _next_link(base, link), {}

    def _next_link(base: str, found: str) -> str | None:
        if "::attr" in listing["next"]:
            return urljoin(base, found)
        if not found.strip().isdecimal() or int(found) >= listing.get("last_page", int(found) + 1):
            return None
        return urljoin(base, f"{listing['numbered']}{int(found) + 1}")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rest, texts in _slices(batches, html):
            bases = rest.column(url).to_pylist()
            rows = [(i, *row) for i, (text, base) in enumerate(zip(texts, bases, strict=True)) for row in of_page(text, base)]
            shared = rest.take(pa.array([r[0] for r in rows], pa.int32()))
            added = [pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string()),
                     pa.array([r[3] for r in rows], pa.string()), _fields_array([r[4] for r in rows])]
            yield pa.RecordBatch.from_arrays([*shared.columns, *added], [*shared.schema.names, "position", "kind", "link", "fields"])

    return pages.mapInArrow(parse, schema)


def extract_listing_links(pages: DataFrame, listing: dict) -> DataFrame:
    """Distinct absolute links of listing pages: (page_id, kind, link)."""
    blocks = extract_blocks(pages.select("page_id", "url", "html"), listing)
    wanted = F.col("link").isNotNull() & ((F.col("kind") == "next") | tx.is_detail_link(F.col("link")))
    return blocks.where(wanted).select("page_id", "kind", "link").distinct()


def extract_links_from_json(responses: DataFrame, listing: dict) -> DataFrame:
    """Links inside ``{"html": "<fragment>"}`` bodies of successful responses."""
    fragments = responses.where(F.col("status") == 200).select(
        "page_id", "url", F.get_json_object("body", "$.html").alias("html"))
    return extract_listing_links(fragments.where(tx.strip(F.col("html")) != ""), listing)


# ------------------------------------------------------------ site items
def _list(name: str) -> Column:
    return F.try_element_at(F.col("fields"), F.lit(name))


def _item_columns(table: str, as_of: str) -> dict[str, Column]:
    first = {name: tx.first_raw(_list(name)) for name in site_rules.DETAIL_RULES[table]}
    label = {name: tx.clean_label(c) for name, c in first.items()}
    if table == "emplois":
        return {
            "title": first["title"], "location": tx.join_fragments(_list("location"), ", "),
            "company_name": first["company_name"],
            "posted_date": parse_iso_date(first["posted_date"]).cast("string"),
            "description_p": tx.join_fragments(_list("description_p"), "\n"),
            "description_ul": tx.join_fragments(_list("description_ul"), "\n"),
            "contract_type": first["contract_type"],
        }
    if table == "senjobs":
        return {
            "salaire": tx.salary_fragment(_list("cells")), "contract_type": first["contract_type"],
            "description": tx.join_fragments(_list("description"), "\n"), "categorie": first["categorie"],
        }
    if table == "emploi_expatdakar":
        pairs = F.arrays_zip(_list("property_title").alias("dt"), _list("property_value").alias("dd"))
        properties = {
            name: tx.clean_label(tx.property_value(pairs, text)) for text, name in site_rules.PROPERTY_LABELS.items()
        }
        return properties | {
            "title": label["title"],
            "posted_date": parse_posted_fr(label["posted_date"], as_of).cast("string"),
            "ad_id": tx.first_digits(first["ad_id"]),
            "location": label["location"], "region": label["region"],
            "description": F.array_join(_list("description"), "\n"),
        }
    if table == "concoursn_stages":
        return {
            "title": first["title"],
            "categories": tx.labels_to_json(_list("categories")), "tags": tx.labels_to_json(_list("tags")),
            "posted_date": parse_relative_fr(first["posted_date_raw"], as_of),
            "description": tx.join_fragments(_list("description"), "\n"),
            "company": tx.company_from_title(first["title"]), "scraped_at": moment(as_of),
        }
    joined = {n: F.array_join(_list(n), "\n") for n in ("description", "job_missions", "job_profile", "job_criteria",
                                                       "job_skills")}
    cleaned = {n: tx.strip_colon(first[n]) for n in ("contract", "region", "education", "experience", "skills")}
    return first | joined | cleaned | {
        "posted": F.substring(first["posted"], 1, 10).try_cast("date"), "scraped_at": moment(as_of)}


def extract_offers_from_pages(pages: DataFrame, table: str, as_of: str) -> DataFrame:
    """Detail pages (page_id, url, html) of one site as rows of its raw table."""
    fields = extract_fields(pages.select("url", "html"), site_rules.DETAIL_RULES[table])
    columns = _item_columns(table, as_of) | {
        "id": tx.url_id(F.col("url")), "url": F.col("url"), "source": F.lit(site_rules.SOURCE_NAMES[table])}
    return fields.select(*[c.alias(name) for name, c in columns.items()])


def extract_listing_items(pages: DataFrame) -> DataFrame:
    """Offers as far as the table listing shows them: title, place, dates and detail link."""
    blocks = extract_blocks(pages.select("page_id", "url", "html"), site_rules.LISTING_RULES["senjobs"])
    rows = blocks.where((F.col("kind") == "detail") & tx.is_detail_link(F.col("link")))
    return rows.select(
        tx.url_id(F.col("link")).alias("id"), F.col("link").alias("url"),
        tx.strip(tx.first_raw(_list("title"))).alias("title"),
        tx.collapse_ws(tx.first_raw(_list("location"))).alias("location"),
        tx.iso_date_fragment(_list("posted_fragments")).alias("posted_date"),
        tx.nth_fragment(_list("expiration_fragments"), 1).alias("expiration"),
        F.lit(site_rules.SOURCE_NAMES["senjobs"]).alias("source"))
