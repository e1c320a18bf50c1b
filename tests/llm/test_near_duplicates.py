"""SimHash groups and vector groups against all pairs."""

import math
from itertools import combinations

import numpy as np
import pytest
import xxhash

from offerflow.llm import embeddings, simhash
from offerflow.llm.common import components


def smallest_reachable(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def plain_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{i}" for i in rng.integers(0, 400, 300)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(60):
        words = base[i % 3].split()
        words[int(rng.integers(0, len(words)))] = f"x{i}"
        rows.append((100 + i, " ".join(words)))
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, base[0].upper()), (304, base[0]), (304, base[0]), (None, base[5]), (305, "one two"),
             (306, "nbsp stays in words here now"), (307, "long " * 70000)]
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, key int, fp int, mark string")


@pytest.mark.parametrize(("distance", "limit"), [(4, 2048), (4, 3), (3, 3), (1, 2048)])
def test_simhash_groups_are_those_of_all_pairs(texts, distance, limit):
    rows = texts.collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    links = [(i, j) for i, j in combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= distance]
    root = smallest_reachable(len(rows), links)
    names = {}
    for r, of in zip(rows, root, strict=True):
        names[of] = min((k for k in (names.get(of), r["doc_id"]) if k is not None), default=None)
    expected = sorted((repr(r["doc_id"]), p, repr(names[of])) for r, p, of in zip(rows, prints, root, strict=True))
    found = simhash.simhash_groups(texts, distance=distance, limit=limit).collect()
    assert sorted((repr(r["key"]), r["fp"] % (1 << 64), repr(r["component"])) for r in found) == expected
    if (distance, limit) == (4, 2048):
        kept = simhash.one_per_group(texts)
        assert kept.columns == texts.columns
        assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(n) for n in names.values())


def test_simhash_of_nothing(texts):
    assert simhash.simhash_groups(texts.where("false")).collect() == []
    assert simhash.one_per_group(texts.where("false")).collect() == []


def test_every_four_positions_hold_a_triple():
    triples = [set(t) for t in simhash.covering_triples()]
    assert len(triples) == 20
    assert all(any(t <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(70, 71), (71, 71), (71, 70)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(chain).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 70: 70, 71: 70}


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 48))
    rows = [(i, (centres[i % 40] + 0.09 * rng.normal(size=48)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(5, rows[5][1]), (None, rows[6][1])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 48), (2003, [math.nan] + [1.0] * 47), (2004, [math.inf] + [1.0] * 47),
             (2005, [None] + [1.0] * 47), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [x * 1e30 for x in rows[0][1]])]
    return spark.createDataFrame([(*r, 0, 1) for r in rows], "vec_id long, embedding array<double>, uid int, n_links int")


@pytest.mark.parametrize("block", [2048, 7])
def test_vector_groups_are_those_of_all_pairs(vectors, block):
    rows = vectors.collect()
    usable = [i for i, r in enumerate(rows) if r["embedding"] and all(x is not None and math.isfinite(x) for x in r["embedding"])
              and any(r["embedding"])]
    links = []
    for i, j in combinations(usable, 2):
        a, b = (np.array(rows[k]["embedding"]) for k in (i, j))
        if len(a) == len(b):
            a, b = a / np.abs(a).max(), b / np.abs(b).max()
            if a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.95:
                links.append((i, j))
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    root = smallest_reachable(len(rows), links)
    names = {}
    for r, of in zip(rows, root, strict=True):
        names[of] = min((k for k in (names.get(of), r["vec_id"]) if k is not None), default=None)
    expected = sorted((repr(r["vec_id"]), int(d), repr(names[of])) for r, d, of in zip(rows, degree, root, strict=True))
    found = sorted((repr(r["key"]), r["n_links"], repr(r["component"])) for r in embeddings.vector_groups(vectors, block=block).collect())
    assert sum(f[1] for f in found) >= 0.9 * sum(e[1] for e in expected)  # index recall
    assert all(f[1] <= e[1] for f, e in zip(found, expected, strict=True))
    assert found == expected  # with the default parameters no link of these is missed


def test_vectors_of_nothing(vectors):
    assert embeddings.vector_groups(vectors.where("false")).collect() == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose((embeddings.hadamard(x) ** 2).sum(1), (x ** 2).sum(1))
    assert np.allclose(embeddings.hadamard(embeddings.hadamard(x)), x)
