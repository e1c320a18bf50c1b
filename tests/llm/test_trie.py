"""The conversation trie against a plain one, and the numbers it searches by."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from offerflow.llm.oracles import ORACLES
from offerflow.llm.trie import digests, prefix_trie, rebuilt, two_fattest

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, conv string, symbol int, depth int"


def plain(built):
    """All prefixes in a dictionary; the same columns."""
    members, kids = defaultdict(list), defaultdict(set)
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
            if d:
                kids[turns[:d - 1]].add(turns[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    return sorted((min(c), len(p), min(members[p[:-1]]) if p else None, len(c), len(kids[p]) if p in kids else 0, leaves[p], saved[p],
                   hashlib.sha256(",".join(str(x) for x in sorted(c) if built[x] == p).encode()).hexdigest())
                  for p, c in members.items()) if built else []


def built_from(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            symbol = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, symbol, (role or "", text or "")))
    own = {c: tuple(t[3] for t in sorted(turns)) for c, turns in own.items()}
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - c % 100 if c >= 0 else c + -c % 100
        found[c] = own.get(base, ())[:h] + turns[h:]
    return found


def trie(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in prefix_trie(*rebuilt(digests(frame))).select(*COLUMNS).collect())


def test_two_fattest(spark):
    pairs = [(a, b) for b in range(1, 70) for a in range(b)] + [(0, 2**40 + 5), (2**40, 2**40 + 1)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", two_fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for a, b, f in got:
        if b < 100:
            assert f == max(range(a + 1, b + 1), key=lambda k: k & -k)
        else:
            assert a < f <= b and f in (2**40, 2**40 + 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_trie(spark, seed):
    r = random.Random(seed)
    rows = [(c, t, r.choice(["user", "assistant"]), r.choice("ab") * r.randint(0, 2), "x", 1, 1)
            for c in range(120) for t in range(r.choice([1, 2, 3, 5, 9, 17]))]
    rows += [(1000 + c, t, "user", "a" * (t % 3), "x", 1, 1) for c in range(60) for t in range(6)]      # many copies
    rows += [(3000, t, "user", "same", "x", 1, 1) for t in range(150)] + [(3100 + c, t, "user", "same", "x", 1, 1) for c in range(8) for t in range(9 * c)]
    rows += [(2001, None, None, None, "x", 1, 1), (2001, None, "user", None, "x", 1, 1), (2001, 0, "", "long " * 5000, "x", 1, 1)]
    rows += [(2002, 1, "b", "tie", "x", 1, 1), (2002, 1, "a", "tie", "x", 1, 1), (2002, 1, "a", "tie", "x", 1, 1)]
    rows += [(None, 1, "user", "nobody", "x", 1, 1), (-5, 0, "user", "a", "x", 1, 1), (-105, 0, "user", "a", "x", 1, 1), (-105, 1, "us", "era", "x", 1, 1)]
    assert trie(spark, rows) == plain(built_from(rows))


def test_a_single_batch_gives_the_same(spark):
    r = random.Random(5)
    rows = [(c, t, "u", r.choice("ab"), "x", 1, 1) for c in range(80) for t in range(r.randint(1, 7))]
    turns, convs = rebuilt(digests(spark.createDataFrame(rows, SCHEMA)))
    one, many = (sorted(map(tuple, prefix_trie(turns, convs, b).collect())) for b in ((1,), (1, 3, 8)))
    assert one == many


def test_turnless_and_empty(spark):
    rows = [(c, 0, "u", "t", "x", 1, 1) for c in (101, 102, 104, 205)]
    found = built_from(rows)
    assert () in found.values()
    assert trie(spark, rows) == plain(found)
    assert trie(spark, [(101, 0, "u", "t", "x", 1, 1)]) == plain(built_from([(101, 0, "u", "t")]))
    assert trie(spark, []) == []


def test_sql_agrees_on_ties_and_nulls():
    rows = [(c, t % 3 if t else None, "u" if c % 3 else None, "ab"[(c + t) % 2] if t % 4 else None) for c in range(90, 330) for t in range(c % 5)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    result = con.execute(ORACLES["op12_trie"])
    names = [d[0] for d in result.description]
    assert sorted(tuple(row[names.index(c)] for c in COLUMNS) for row in result.fetchall()) == plain(built_from(rows))
