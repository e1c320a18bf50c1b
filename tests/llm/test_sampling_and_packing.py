"""Mixing against a direct calculation; packing as an exact round trip."""

import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from offerflow.llm import mixing, packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, size string, copies int, length int, key int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(["w"] * (i * 7 % 41)), f"s{i % 4}") for i in range(200)]
    rows += [(500, None, "s0"), (501, "", None), (None, "a b c", None), (502, "x " * 9000, "s1"), (503, "a b", "é"),
             (7, "again", "s2"), (7, "again", "s2")]
    return spark.createDataFrame([(*r, "clash", 9, 9, 9) for r in rows], SCHEMA)


def water_filling(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what exceeds a limit is shared again among the others."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if weight[n] * level > most * sizes[n]}
        if not full:
            target.update((n, weight[n] * level) for n in open_)
            break
        target.update((n, float(most * sizes[n])) for n in full)
        left -= sum(most * sizes[n] for n in full)
        open_ -= full
    return target


def test_mix_reaches_its_targets(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["row"]["text"] or ""))
        assert 0 <= r["copies"] <= 3
        sizes[r["source"]] += r["size"]
    target, longest, taken = water_filling(sizes), Counter(), Counter()
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-12)
        assert r["source_size"] == sizes[r["source"]]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
        taken[r["source"]] += r["copies"] * r["size"]
    for source, words in target.items():
        assert abs(taken[source] - words) <= 1.5 * longest[source]


def test_mix_takes_documents_whole_and_alike(docs):
    again = [sorted(map(repr, mixing.mixed(docs).collect())) for _ in range(2)]
    assert again[0] == again[1]
    expected = sum(r["copies"] for r in mixing.mix(docs).collect())
    assert len(again[0]) == expected
    assert mixing.mixed(docs).columns == docs.columns


def test_mix_of_nothing(docs):
    assert mixing.mix(docs.where("false")).collect() == []


def test_pieces_hold_every_id_once(spark, docs):
    extra = [(900, "Don't STOP 12'3 éÉ ﬁ <|endoftext|>x <|ENDOFTEXT|> ﷺ a", None), (901, "word " * 5000, None)]
    docs = docs.union(spark.createDataFrame([(*r, "clash", 1, 1, 1) for r in extra], SCHEMA))
    rows = packing.pack(docs, VOCABULARY).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        for start in range(0, len(ids), 4096):
            part = ids[start:start + 4096]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            expected[r["doc_id"], start, len(part), crc, len(ids)] += 1
    assert Counter((r["key"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == expected
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(docs.where("false"), VOCABULARY).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=20))
def test_patterns_use_the_histogram_up(histogram):
    found = packing.patterns(histogram, 64)
    used = Counter()
    for pattern, count in found:
        assert sum(size * times for size, times in pattern) <= 64
        for size, times in pattern:
            used[size] += times * count
    assert used == Counter(histogram)
    ranks = defaultdict(list)
    for size, low, high, *_ in packing.slots(found):
        ranks[size].append((low, high))
    for size, spans in ranks.items():
        ends = sorted(spans)
        assert [low for low, _ in ends] == [0, *(high for _, high in ends[:-1])]
        assert ends[-1][1] == histogram[size]


def test_short_packs_are_filled_first():
    assert dict(packing.patterns({10: 2, 3: 4}, 16)) == {((10, 1), (3, 2)): 2}


def test_capitals_with_marks_keep_their_ids(spark):
    marks = [chr(c) for c in range(0x300, 0x370)] + ["̧̱", "֑̌", "̱᷄", "é", "⃝"]
    texts = [f"Aa {letter}{mark}b Zz" for letter in "HTWYJKAE" for mark in marks]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = Tokenizer.from_file(VOCABULARY)
    found = {r["key"]: r["ids_crc32"] for r in packing.pieces(docs, VOCABULARY).collect()}
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        assert found[i] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)), text
