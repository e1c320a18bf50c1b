"""Hard negatives: certain intervals, and results against a plain search over all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerflow.llm.negatives import Anchors, Mining, encode, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, anchor_id string, score int"


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_intervals_hold_every_product(dim):
    random = np.random.default_rng(dim)
    x = np.floor(256 * random.normal(size=(200, dim)))
    x[5], x[6], x[7] = x[4], 0, 1000 * x[4]
    for levels, bits in ((1, 1), (2, 4), (5, 6)):
        low, high = Anchors(x[:20], bits, levels, 3).intervals(np.arange(20), encode(x, levels, 3))
        exact = x[:20] @ x.T
        assert (low <= exact).all() and (exact <= high).all()
    assert (high - low).mean() < 0.5 * np.outer(*[np.sqrt((v * v).sum(1)) for v in (x[:20], x)]).mean()


def plain(rows, is_anchor, m):
    """Every anchor against every row, in Python integers."""
    live = {}
    for key, vector, label, *_ in rows:
        if key is not None and label is not None and vector is not None and all(v is not None and math.isfinite(v) for v in vector):
            live[(key, label, tuple(vector))] = [math.floor(m.scale * v) for v in vector]
    found = []
    for (a, la, _), va in live.items():
        if not is_anchor(a):
            continue
        scored = [(-sum(p * q for p, q in zip(va, vb, strict=False)), b, lb) for (b, lb, _), vb in live.items() if b != a or lb != la]
        for sp, p, _ in sorted(s for s in scored if s[2] == la)[:m.positives]:
            fit = sorted(s for s in scored if s[2] != la and m.low * -sp <= 100 * -s[0] <= m.high * -sp)[:m.negatives]
            found += [(a, p, r, n, -sp, -sn) for r, (sn, n, _) in enumerate(fit, 1)]
    return sorted(found)


def mined(spark, rows, m=Mining(), schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    return sorted(tuple(r) for r in hard_negatives(frame, F.col("vec_id") % 5 == 0, mining=m).collect())


@pytest.mark.parametrize("m", [Mining(), Mining(levels=1, bits=2, rows=20, anchors=4), Mining(positives=2, negatives=9, low=-50)])
def test_against_all_pairs(spark, m):
    random = np.random.default_rng(1)
    centres = random.normal(size=(3, 8))
    rows = [(i, (centres[i % 3] + 0.7 * random.normal(size=8)).tolist(), int(random.integers(4)), "x", 1) for i in range(150)]
    rows += [(150 + i, rows[3][1], i % 4, "x", 1) for i in range(40)]       # a large group of equal vectors, ties by key
    rows += [rows[0], rows[0], (7, rows[9][1], 2, "x", 1)]                   # repeated rows, and a key with two rows
    rows += [(300, None, 1, "x", 1), (305, [1.0, None] * 4, 1, "x", 1), (310, [float("nan")] * 8, 1, "x", 1),
             (315, [float("inf")] * 8, 1, "x", 1), (320, rows[1][1], None, "x", 1), (None, rows[1][1], 1, "x", 1),
             (325, [0.0] * 8, 1, "x", 1), (330, [], 2, "x", 1), (335, [5.0, 5.0], 3, "x", 1)]
    assert mined(spark, rows, m) == plain(rows, lambda a: a % 5 == 0, m)


def test_large_components_are_scored_in_integers(spark):
    rows = [(i, [2.0**40 + i, 1.0 + i / 256], i % 2, "x", 1) for i in range(12)]
    m = Mining(scale=1.0)
    assert mined(spark, rows, m) == [
        (a, p, r, n, min(sp, 2**63 - 1), min(sn, 2**63 - 1)) for a, p, r, n, sp, sn in plain(rows, lambda a: a % 5 == 0, m)]


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0, "x", 1)]) == []
    assert mined(spark, [(0, [1.0], 0, "x", 1), (5, [1.0], 0, "x", 1)]) == []
