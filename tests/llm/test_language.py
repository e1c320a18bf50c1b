"""The byte network against a plain one, its gradients, and the languages of held-out texts."""

import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerflow.llm import language
from offerflow.llm.language import Network, Settings
from offerflow.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string, key int"


def random_network(s, classes=3, dtype=np.float64):
    net = language._start(classes, s)
    return Network(*(getattr(net, n).astype(dtype) for n in ("inputs", "turn", "out", "bias")))


def plain(net, codes):
    """Probabilities at every position of one span, one number after the other."""
    h, logistic = net.turn.shape[2], lambda x: 1 / (1 + np.exp(-x))
    states = np.zeros((2, len(codes), h))
    for side, order in ((0, range(len(codes))), (1, range(len(codes) - 1, -1, -1))):
        state = np.zeros(h)
        for at in order:
            given, turned = net.inputs[side][:, codes[at]], net.turn[side] @ state
            update, reset = logistic(given[:h] + turned[:h]), logistic(given[h:2 * h] + turned[h:2 * h])
            state = update * state + (1 - update) * np.tanh(given[2 * h:] + reset * turned[2 * h:])
            states[side, at] = state
    score = np.exp(states.transpose(1, 0, 2).reshape(len(codes), -1) @ net.out.T + net.bias)
    return score / score.sum(axis=1, keepdims=True)


def test_texts_are_pooled_as_by_a_plain_network():
    s = Settings(hidden=4, span=7, margin=3)
    net, texts = random_network(s), [b"", b"a", b"hello w", b"hello wo", "café 日本".encode(), bytes(range(60))]
    found = language.pooled(net, np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0] + [len(t) for t in texts]), s, block=3)
    for text, got in zip(texts, found, strict=True):
        wide = [256] * s.margin + list(text) + [256] * (s.margin + s.span)
        total = np.zeros(3)
        for low in range(0, len(text), s.span):
            inside = min(s.span, len(text) - low)
            total += plain(net, wide[low:low + 2 * s.margin + s.span])[s.margin:s.margin + inside].sum(axis=0)
        np.testing.assert_allclose(got, total / max(1, len(text)), atol=1e-6)


def test_gradients_are_slopes_of_the_loss():
    s = Settings(hidden=3)
    net, random = random_network(s), np.random.default_rng(0)
    codes, y = random.integers(0, 5, (6, 4)), np.array([0, 1, 2, 1])
    codes[4:, 1] = 256

    def loss(n):
        p = [plain(n, codes[:, b]) for b in range(4)]
        inside = codes != 256
        return -sum(np.log(p[b][t, y[b]]) for b in range(4) for t in range(6) if inside[t, b]) / inside.sum()

    found, value = language._gradients(net, codes, y)
    assert value == pytest.approx(loss(net), abs=1e-5)
    for name in ("inputs", "turn", "out", "bias"):
        array, given = getattr(net, name), getattr(found, name)
        for _ in range(12):
            at = tuple(int(random.integers(n)) for n in array.shape)
            if name == "inputs":
                at = (*at[:2], int(random.choice([0, 1, 2, 3, 4, 256])))
            slopes = []
            for sign in (1, -1):
                moved = array.copy()
                moved[at] += sign * 1e-3
                slopes.append(loss(replace(net, **{name: moved})))
            assert given[at] == pytest.approx((slopes[0] - slopes[1]) / 2e-3, abs=2e-4)


def test_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op13_language"](spark, SF_DIR).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 20
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def identified(spark, rows, teaches="doc_id < 100", s=Settings(steps=60, rows=30)):
    found = language.identified(spark.createDataFrame(rows, SCHEMA).repartition(3), F.expr(teaches), settings=s)
    assert found.columns == ["key", "lang_pred", "score"]
    return found.collect()


def texts(random, letters, n):
    return [" ".join("".join(random.choice(list(letters), random.integers(1, 7))) for _ in range(random.integers(5, 60))) for _ in range(n)]


def test_odd_texts(spark):
    random = np.random.default_rng(2)
    rows = [(i, t, "xx", "?", "?", 0) for i, t in enumerate(texts(random, "abcdefg", 40))]
    rows += [(40 + i, t, "yy", "?", "?", 0) for i, t in enumerate(texts(random, "hijklmn", 40))]
    rows += [(90, None, "xx", "?", "?", 0), (91, "", "xx", "?", "?", 0), (92, "12 34!", "zz", "?", "?", 0), (93, "abc", None, "?", "?", 0)]
    odd = [(200, None, None, "?", "?", 0), (201, "", "yy", "?", "?", 0), (202, "1 2 3 …", "yy", "?", "?", 0), (203, "cab fed " * 40000, "yy", "?", "?", 0),
           (204, "nil kin", "xx", "?", "?", 0), (204, "nil kin", "xx", "?", "?", 0), (None, "hill jinn", None, "?", "?", 0)]
    rows = identified(spark, rows + odd)
    found = {r["key"]: (r["lang_pred"], r["score"]) for r in rows}
    assert len(rows) == 91
    assert all(found[k] == ("und", 0.0) for k in (90, 91, 92, 200, 201, 202))
    assert found[203][0] == "xx" and found[204][0] == "yy" and found[None][0] == "yy"
    assert sum(found[i][0] == "xx" for i in range(40)) >= 39 and sum(found[40 + i][0] == "yy" for i in range(40)) >= 39


def test_nothing_to_learn(spark):
    assert identified(spark, []) == []
    assert [tuple(r) for r in identified(spark, [(500, "some text", "xx", "?", "?", 0)])] == [(500, "und", 0.0)]
    assert [tuple(r) for r in identified(spark, [(1, "some text", "xx", "?", "?", 0)])] == [(1, "xx", 1.0)]


def test_labels_of_held_out_texts_are_not_read(spark):
    random = np.random.default_rng(3)
    rows = [(i, t, "xx" if i % 2 else "yy", "?", "?", 0) for i, t in enumerate(texts(random, "abcdefg", 30))]
    other = [(k, t, "zz" if k >= 20 else lang, *rest) for k, t, lang, *rest in rows]
    a, b = (sorted(map(tuple, identified(spark, r, "doc_id < 20", Settings(steps=5)))) for r in (rows, other))
    assert a == b
