"""Archives as a round trip, main text on known pages, and the suffix tree against a plain one."""

import base64
import gzip
import hashlib
import math
from collections import Counter

import pytest

from offerflow.llm import html, lm, warc


def test_archives_round_trip(spark, tmp_path):
    pages = [(5, "http://a.example/x y\n", "<p>é</p>\r\n\r\nWARC/1.1\n"), (3, None, ""), (4, "http://b.example", None), (9, "http://c.example", "same"),
             (2, "http://d.example", "same"), (2, "http://d.example", "same"), (None, "http://e.example", "same"), (11, "u", "long " * 300000)]
    frame = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, digest int, type string").repartition(3)
    rows = warc.archived(frame, folder=str(tmp_path)).collect()
    assert len(rows) == len(pages)
    first = {}
    for key, _, text in pages:
        data = (text or "").encode()
        first[data] = min(first.get(data, math.inf), math.inf if key is None else key)
    expected = Counter()
    for key, _, text in pages:
        data = (text or "").encode()
        expected[key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode()] += 1
    assert Counter((r["key"], r["bytes"], r["digest"]) for r in rows) == expected
    kinds = Counter((r["key"], r["type"], r["refers_to"]) for r in rows)
    assert kinds == Counter([(5, "response", None), (3, "response", None), (4, "revisit", 3), (9, "revisit", 2), (2, "response", None),
                             (2, "revisit", 2), (None, "revisit", 2), (11, "response", None)])
    files = list((tmp_path / "warc").rglob("*.gz"))
    assert files
    data = gzip.decompress(files[0].read_bytes())
    records = list(warc.read_warc(data))
    assert records[0][0]["warc-type"] == "warcinfo"
    versions = {gzip.decompress(f.read_bytes()).split(b"\n")[1][:1] for f in (tmp_path / "arc").rglob("*.gz")}
    assert versions == {b"1", b"2"}
    assert warc.archived(frame, least_bytes=5).where("type = 'revisit'").count() == 0


def test_archive_of_nothing(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(frame).collect() == []


def test_arc_versions_and_lengths():
    one = warc.arc_version_block(1, "a", "20250101000000") + b"\nhttp://x 1.2.3.4 20240102030405 text/html 5\na\nb\n\n\n"
    two = warc.arc_version_block(2, "b", "20250101000000") + b"\nhttp://y 1.2.3.4 20240102030405 image/gif 200 c - 7 b 3\n\xff\x00\n\n"
    first, second = next(warc.read_arc(one)), next(warc.read_arc(two))
    assert (first["URL"], first["content"], "Checksum" in first) == ("http://x", b"a\nb\n\n", False)
    assert (second["URL"], second["content"], second["Result-code"]) == ("http://y", b"\xff\x00\n", "200")
    with pytest.raises(ValueError, match="declares"):
        list(warc.read_arc(one[:-4]))


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li>a</ul></nav><!-- no --><div class="ad">buy</div>{open}<h1>Title &amp; {n}</h1><p><b>Bold {n}<br>x<p>Second&nbsp;
 &#233; {n}</p><div class="promo-box">promo</div>{extra}<section class="comments"><p>me too</p></section>{close}
<div id="cookie-notice">ok?</div><aside>s</aside><form>f</form><footer>&copy; {n}</footer></body>"""


def test_main_text(spark):
    rows = [(i, f"http://one.example/{i}", PAGE.format(n=i, open="<article>", close="</article>", extra="<p>Shared by all.</p>")) for i in range(8)]
    rows += [(100 + i, f"https://two.example:80/{i}", PAGE.format(n=i, open='<div class="body">', close="</div>",
                                                                 extra='<div class="box"><p>Same box</p></div>')) for i in range(8)]
    rows += [(200, None, "<p>a<p>b"), (201, "http://x", None), (202, "http://x", ""), (203, "odd", "plain &lt; text"), (0, rows[0][1], rows[0][2]),
             (204, "http://x", "<p>" + "w " * 100000), (None, "http://x", "<table><tr><td>1<td>2</table>")]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, blocks int, host int")
    found = {}
    result = html.main_text(pages).collect()
    assert len(result) == len(rows)
    for r in result:
        found.setdefault(r["key"], r["text"])
    for i in range(8):
        assert found[i] == f"Title & {i}\nBold {i} x\nSecond é {i}\nShared by all."
        assert found[100 + i] == f"Title & {i}\nBold {i} x\nSecond é {i}"  # the box says the same on all pages of the site
    assert (found[200], found[201], found[202], found[203], found[None]) == ("a\nb", "", "", "plain < text", "1\n2")
    assert len(found[204].split()) == 100000
    assert html.main_text(pages.where("false")).collect() == []


TRAIN = ["the cat sat on the mat", "the cat sat on the hat", "a dog sat on the mat", "the cat ran", "The Cat sat", "", None] * 4
HELD = ["the cat sat on a mat", "unseen words here", "the dog sat on the mat", None]


def plain_scores(settings):
    """The same model, one dictionary per context length."""
    train = [[w.decode() for w in lm.tokens_of(t)] + ["</s>"] for t in TRAIN]
    counts = Counter(w for d in train for w in d)
    total, size = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    grams = Counter()
    for d in train:
        for i in range(len(d)):
            for k in range(1, settings.depth + 2):
                if i >= k - 1:
                    grams[tuple(d[i - k + 1:i + 1])] += 1
    states = {}

    def prob(context, token):
        """Of the longest kept suffix."""
        for k in range(len(context), 0, -1):
            state = states.get(context[-k:])
            if state:
                share, back = state
                return share.get(token, 0.0) + back * prob(context[-k + 1:] if k > 1 else (), token)
        return (counts.get(token, 0) + 1) / size

    for k in range(1, settings.depth + 1):
        found = {}
        for gram, n in grams.items():
            if len(gram) == k + 1 and n >= settings.least:
                found.setdefault(gram[:-1], {})[gram[-1]] = n
        new = {}
        for context, following in found.items():
            seen = grams[context]
            share = {w: (n - settings.discount) / seen for w, n in following.items()}
            back = 1 - sum(share.values())
            suffix = context[1:]
            own = {w: share[w] + back * prob(suffix, w) for w in following}
            gain = sum(n * math.log(own[w] / prob(suffix, w)) for w, n in following.items())
            rest = seen - sum(following.values())
            gain += rest * math.log(back) if rest else 0.0
            if gain >= settings.cutoff * len(following):
                new[context] = (share, back)
        states.update(new)
    result = {}
    for i, text in enumerate(TRAIN + HELD):
        tokens = [w.decode() for w in lm.tokens_of(text)] + ["</s>"]
        result[i] = (len(tokens), sum(counts[t] > 0 for t in tokens), sum(math.log10((counts[t] + 1) / size) for t in tokens),
                     sum(math.log10(prob(tuple(tokens[max(0, j - settings.depth):j]), t)) for j, t in enumerate(tokens)))
    vocabulary = [*counts, "<unseen>"]
    for context in [(), *states]:
        assert sum(prob(context, w) for w in vocabulary) == pytest.approx(1)
    return result, total, states


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_suffix_tree_is_that_of_plain_python(spark, broadcast):
    from pyspark.sql import functions as F

    settings = lm.Settings(least=4, cutoff=0.5, broadcast=broadcast)
    expected, total, states = plain_scores(settings)
    assert {len(c) for c in states} == {1, 2}  # contexts of different lengths
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(TRAIN + HELD)], "doc_id long, text string, score int, held_out int")
    rows = lm.scores(docs, held=F.col("doc_id") >= len(TRAIN), settings=settings).collect()
    assert len(rows) == len(expected)
    for r in rows:
        n, known, base, score = expected[r["key"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert (r["base_score"], r["score"]) == (pytest.approx(base), pytest.approx(score))


def test_scores_of_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a b", 1), (2, "a", 1), (2, "a", 1), (13, "long " * 100000, 1)], "doc_id long, text string, uid int")
    rows = lm.scores(docs).collect()
    assert sorted(r["n_tokens"] for r in rows) == [2, 2, 3, 100001]
    assert lm.scores(docs.where("false")).collect() == []
    none = lm.scores(docs, held=docs["doc_id"].isNotNull() | docs["doc_id"].isNull()).collect()
    assert {(r["base_score"], r["score"], r["train_tokens"]) for r in none} == {(0.0, 0.0, 0)}


def near_copies(n, opened, closed, host):
    return [(1000 + i, f"http://{host}/{i}", f"<body>{opened}" + "".join(f"<p>Shared paragraph {k} of the text.</p>" for k in range(10))
             + f"<p>Copy {i}.</p>{closed}</body>") for i in range(n)]


@pytest.mark.parametrize("around", [("<div class=body>", "</div>"), ("<div><article>", "</article></div>")])
def test_near_copies_keep_their_article(spark, around):
    rows = near_copies(20, *around, "copies.example")
    rows += [(2000 + i, f"http://same.example/{i}", f"<body>{around[0]}<h1>One long text</h1><p>that all the pages share</p>{around[1]}<p>{i}</p>")
             for i in range(6)]  # no block of its own inside the container
    rows += near_copies(300, *around, "both.example")
    box = "<div class=box><p>Same box</p></div>"
    rows += [(3000 + i, f"http://both.example/u{i}", f"<body>{around[0]}<p>A page of its own, number {i}.</p>{box}{around[1]}</body>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html.main_text(pages).collect():
        i = r["key"]
        if i < 2000:
            assert r["text"].count("Shared paragraph") == 10 and r["text"].endswith(f"Copy {i - 1000}.")
        elif i < 3000:
            assert r["text"].startswith("One long text\nthat all the pages share")
        else:
            assert r["text"] == f"A page of its own, number {i - 3000}."


def test_text_outside_the_article_stays(spark):
    rows = [(1, "http://a.example/1", "<body><nav>menu</nav><h1>Title</h1><p>Lead</p><article><p>Body</p></article><p>Goes on</p><footer>f</footer></body>"),
            (2, "http://a.example/2", "<body><div><p>The long body</p></div><article>Teaser</article><aside>no</aside></body>")]
    rows += [(10 + i, f"http://b.example/{i}", f"<body><div><p>Subscribe here</p></div><article><p>Page {i} speaks of {i * i}</p></article><p>End {i}</p></body>")
             for i in range(8)]
    found = {r["key"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (found[1], found[2]) == ("Title\nLead\nBody\nGoes on", "The long body\nTeaser")
    assert all(found[10 + i] == f"Page {i} speaks of {i * i}\nEnd {i}" for i in range(8))  # the tree still removes what repeats


@pytest.mark.parametrize("opened", [
    "<div id=wrapper class='with-sidebar'>", "<div class=has-sidebar>", "<div class=no-comments>", "<div class=layout-sidebar>",
    "<div id='search-result-article'>", "<section class='related-work'>", "<div class=hasSidebar>", "<div class=sidebar>", "<section class=comments>"])
@pytest.mark.parametrize("body", ["<p>The whole main text of the page</p>", "<article><p>The whole main text of the page</p></article>"])
def test_names_of_wrappers_drop_nothing(opened, body):
    end = f"</{opened[1:].split()[0]}>"
    noise = "<div class='left-sidebar'><p>links</p></div><div class='ad'>buy</div><ul id=commentList class='x y'><li>me</ul>"
    blocks, features = html.parse(f"<body>{opened}{body}<div class=promo-box>no</div>{end}<p>tail</p>{noise}</body>")
    assert [b[0] for b in blocks] == ["The whole main text of the page", "tail"]
    assert opened.startswith("<section class=r") or any(f[1:3] == (1, blocks[0][1]) for f in features)


def test_comments_longer_than_the_article_go():
    blocks, _ = html.parse("<article><p>Short</p></article><div class=comments><p>" + "long " * 50 + "</p></div>")
    assert [b[0] for b in blocks] == ["Short"]
    blocks, _ = html.parse("<div><p>The text of the page</p></div><article class=comment>me too</article>")
    assert [b[0] for b in blocks] == ["The text of the page"]
    nested, _ = html.parse("<div class=sidebar><p>most of the text is here</p><span class=share>Share</span> now</div>")
    assert [b[0] for b in nested] == ["most of the text is here", "now"]


def test_archives_keep_their_order_when_sorts_spill(spark, tmp_path):
    conf, name = spark._jvm.org.apache.spark.SparkEnv.get().conf(), "spark.shuffle.spill.numElementsForceSpillThreshold"
    frame = spark.range(0, 3000, 1, 1).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "repeat(cast(id AS string), cast(id % 40 AS int)) AS html")
    conf.set(name, "100")
    try:
        warc.write_arc(frame, str(tmp_path / "arc"), versions=(2,))
        warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    finally:
        conf.remove(name)
    (arc,) = (tmp_path / "arc").rglob("*.gz")
    records = list(warc.read_arc(gzip.decompress(arc.read_bytes())))
    assert [r["URL"] for r in records] == [f"http://x/{i}" for i in range(3000)]
    assert all(int(r["Offset"]) == r["offset"] for r in records)
    for path in (tmp_path / "warc").rglob("*.gz"):
        kinds = [fields["warc-type"] for fields, _ in warc.read_warc(gzip.decompress(path.read_bytes()))]
        assert kinds[0] == "warcinfo" and kinds.count("warcinfo") == 1
