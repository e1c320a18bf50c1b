"""Prefix trie of conversations: a z-fast trie over turns, filled in batches by fat binary search.

A conversation is a string of turns. All its prefixes lie in a table (conv, depth, id); ``id`` names the sequence of
turns. A node of the compacted trie is a branching point or the end of a conversation, and covers the depths (p, e] below
its parent at p; its label is a pointer to one conversation that passes through. The node is found by its handle: the prefix
whose length is the two-fattest number of (p, e], the one that the highest power of two divides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerflow.llm.common import ranked, written

ROOT = "root"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: Sums of that many hashes of 24 bits name a prefix; 24 bits leave room for sums over 2^39 turns.
LANES = 5
#: Member numbers that share this range are joined to one string; the strings of a node are hashed one after the other.
RANGE = 4096


def two_fattest(a: Column, b: Column) -> Column:
    """The number of (a, b] that the highest power of two divides: b without the bits below the highest one in which a and b differ."""
    differ = a.bitwiseXOR(b)
    for shift in (1, 2, 4, 8, 16, 32):
        differ = differ.bitwiseOR(F.shiftright(differ, shift))
    return b.bitwiseAND(F.bitwise_not(F.shiftright(differ, 1)))


def digests(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``symbol`` (hash of role and text) and ``chars`` (code points of the text) of every turn with a conv.

    A null role or text is the empty one.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    return turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("symbol"),
        F.length(text).cast("long").alias("chars"))


def rebuilt(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: ``conv``, ``place`` (from 1), ``symbol``, ``chars``, and the list of all ``conv``.

    ``turns`` are digests. With h = crc32(decimal conv) % most, a conversation begins with the first h turns of conversation
    conv - conv % family (all of them if it has fewer) and goes on with its own turns after its first h. Turns are
    ordered by number, null first; turns of equal number by symbol.
    """
    rows = ranked(turns, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("symbol")], "at")
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    convs = rows.groupBy("conv").agg(F.min("at").alias("begin"), F.count("*").alias("n")).select(
        "conv", "begin", "n", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = written(convs.join(bases, "base", "left").select(
        "conv", "begin", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "conversations")
    rows = written(rows.join(convs, "conv").select(
        "conv", (F.col("at") - F.col("begin") + 1).alias("place"), "symbol", "chars", "h", "taken"), "own-turns")
    opening = rows.where(F.col("place") < most).select(F.col("conv").alias("base"), "place", "symbol", "chars")
    first = convs.select("conv", "base", "h").join(opening, "base").where("place <= h").select("conv", "place", "symbol", "chars")
    later = rows.where("place > h").select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "symbol", "chars")
    return first.unionByName(later), convs.select("conv")


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv``, ``depth``, ``id`` and ``prev`` (of the prefix with and without the last turn), ``cum`` and ``chars``.

    A prefix is named by its length and sums of hashes of (symbol, place): so names come from prefix sums over the
    whole sorted table, and no conversation is gathered anywhere. Different prefixes share a name with a chance of 2^-120.
    """
    lanes = [f"lane{i}" for i in range(LANES)]
    coded = turns.select("conv", "place", "chars", *[
        F.xxhash64("symbol", "place", F.lit(i)).bitwiseAND(F.lit((1 << 24) - 1)).alias(lane) for i, lane in enumerate(lanes)])
    rows = ranked(coded, [F.col("conv"), F.col("place")], sums=(*lanes, "chars")).drop("rank")
    begin = rows.where("place = 1").select(F.col("conv").alias("c"), *[F.col(f"{s}_before").alias(f"{s}_begin") for s in (*lanes, "chars")])
    rows = rows.join(begin, F.col("conv") == F.col("c"))

    def name(last: bool) -> Column:
        sums = [F.col(f"{s}_before") - F.col(f"{s}_begin") + (F.col(s) if last else 0) for s in lanes]
        return F.md5(F.concat_ws(":", F.col("place") - (0 if last else 1), *sums))

    return written(rows.select(
        "conv", F.col("place").alias("depth"), name(True).alias("id"),
        F.when(F.col("place") == 1, ROOT).otherwise(name(False)).alias("prev"),
        (F.col("chars_before") - F.col("chars_begin") + F.col("chars")).alias("cum"), "chars"), "prefixes")


def _exits(batch: DataFrame, nodes: DataFrame, known: DataFrame) -> DataFrame:
    """Where each conversation leaves the trie: ``a`` (end of the last edge that it passes whole) and the edge it leaves on, if any.

    Fat binary search: between a and b the two-fattest depth f is tried. If the prefix of length f is a node's handle, the
    search goes on below the end of that node's edge, else above f. Whether that edge is passed whole is looked up once, at
    the end: if it is not, no deeper prefix is in the trie and all later trials fail. Every round is the same two joins for all
    conversations, and the number of rounds is the logarithm of the longest one.
    """
    handles = nodes.select("handle", F.col("id").alias("hit"), F.col("p").alias("hit_p"), F.col("e").alias("hit_e"))
    tries = known.select("conv", F.col("depth").alias("f"), F.col("id").alias("handle"))
    state = batch.select("conv", "n", "end", F.lit(0).cast("long").alias("a"), F.col("n").alias("b"),
                         F.lit(None).cast("string").alias("node"), F.lit(0).cast("long").alias("p"))
    done = None
    while True:
        tried = state.withColumn("f", two_fattest(F.col("a"), F.col("b"))).join(tries, ["conv", "f"]).join(handles, "handle", "left")
        hit = F.col("hit").isNotNull()
        state = written(tried.select(
            "conv", "n", "end", F.when(hit, F.col("hit_e")).otherwise(F.col("a")).alias("a"),
            F.when(hit, F.col("b")).otherwise(F.col("f") - 1).alias("b"),
            F.when(hit, F.col("hit")).otherwise(F.col("node")).alias("node"),
            F.when(hit, F.col("hit_p")).otherwise(F.col("p")).alias("p")), "search")
        ended = state.where("a >= b")
        done = ended if done is None else done.unionByName(ended)
        state = state.where("a < b")
        if state.isEmpty():
            break
    after = known.select("conv", (F.col("depth") - 1).alias("a"), F.col("prev").alias("there"), F.col("id").alias("next"))
    found = done.join(after, ["conv", "a"], "left")
    there = F.coalesce("there", F.when(F.col("a") == F.col("n"), F.col("end")))
    whole = F.col("node").isNull() | F.coalesce(there == F.col("node"), F.lit(False))
    # an edge is found by its first turn below a whole path, or is the one the search ended on
    found = found.select("conv", "n", F.when(whole, F.col("a")).otherwise(F.col("p")).alias("a"),
                         F.when(whole, F.concat(F.lit("first "), F.col("next"))).otherwise(F.concat(F.lit("node "), F.col("node"))).alias("edge"))
    named = nodes.select("*", F.explode(F.array(F.concat(F.lit("first "), F.col("first")), F.concat(F.lit("node "), F.col("id")))).alias("edge"))
    return found.join(named.drop("handle"), "edge", "left").drop("edge")


def _edges(points: DataFrame, known: DataFrame) -> DataFrame:
    """Nodes of the edges between the points on each path: rows (path, rep, depth, id, cum), the first one of a path the end of a
    known node. Paths that share an edge give its node once; its first prefix and its handle are read off the conversation it points to."""
    up = Window.partitionBy("path").orderBy("depth")
    made = points.select("id", "rep", F.lag("depth").over(up).alias("p"), F.col("depth").alias("e"), F.lag("id").over(up).alias("parent"),
                         "cum", F.lag("cum").over(up).alias("above")).where("p is not null")
    made = made.groupBy("id").agg(F.min_by(F.struct("p", "e", "rep", "parent", "cum", "above"), "rep").alias("node")).select("id", "node.*")
    places = made.withColumn("depth", F.explode(F.array(F.col("p") + 1, two_fattest(F.col("p"), F.col("e")))))
    steps = known.select(F.col("conv").alias("rep"), "depth", F.col("id").alias("there"))
    both = places.join(steps, ["rep", "depth"]).groupBy(*made.columns)
    return both.agg(F.min_by("there", "depth").alias("first"), F.max_by("there", "depth").alias("handle"))


def _inserted(batch: DataFrame, nodes: DataFrame | None, known: DataFrame) -> DataFrame:
    """The compacted trie after a batch of distinct conversations (``conv``, ``n``, ``end``)."""
    if nodes is None:
        places = batch.select("conv", "n", F.lit(0).cast("long").alias("d"))
    else:
        edges = written(_exits(batch, nodes, known), "edges")
        mine = known.select("conv", "depth", F.col("id").alias("mine"), F.col("cum").alias("mine_cum"))
        theirs = known.select(F.col("conv").alias("rep"), "depth", F.col("id").alias("theirs"))
        along = edges.where("id is not null").select("conv", "rep", "a", "e").join(mine, "conv").where("depth > a and depth <= e")
        same = along.join(theirs, ["rep", "depth"]).where("mine = theirs").groupBy("conv").agg(
            F.max("depth").alias("d"), F.max_by(F.struct("mine", "mine_cum"), "depth").alias("cut"))
        edges = written(edges.join(same, "conv", "left").withColumn("d", F.coalesce("d", "a")), "exits")
        places = edges.select("conv", "n", "d")
    fresh = written(known.join(places.where("d < n"), "conv").where("depth > d").drop("n"), "new-turns")
    forks = fresh.groupBy("prev").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select(F.col("prev").alias("id"))
    points = fresh.join(forks.union(batch.select("end")).distinct(), "id", "left_semi").select("conv", "depth", "id", "cum")
    points = points.unionByName(fresh.where("depth = d + 1").select(
        "conv", F.col("d").alias("depth"), F.col("prev").alias("id"), (F.col("cum") - F.col("chars")).alias("cum")))
    points = points.select(F.concat(F.lit("new "), "conv").alias("path"), F.col("conv").alias("rep"), "depth", "id", "cum")
    if nodes is None:
        return written(_edges(points, known), "trie")
    # edges that are left inside are cut there
    left = edges.where("d > a and d < e")
    cuts = left.select(F.col("id").alias("path"), "rep", F.explode(F.array(
        F.struct(F.col("p").alias("depth"), F.col("parent").alias("id"), F.col("above").alias("cum")),
        F.struct(F.col("d").alias("depth"), F.col("cut.mine").alias("id"), F.col("cut.mine_cum").alias("cum")),
        F.struct(F.col("e").alias("depth"), F.col("id"), F.col("cum")))).alias("at")).select("path", "rep", "at.*").distinct()
    kept = nodes.join(left.select("id").distinct(), "id", "left_anti")
    return written(_edges(points.unionByName(cuts), known).unionByName(kept), "trie")


def _subtrees(nodes: DataFrame) -> DataFrame:
    """Nodes with the sums of ``n``, ``leaves``, ``weight``, ``chars`` and the least ``low`` over their subtrees.

    Pointers to ancestors double: after round k a node has gathered all nodes less than 2^k levels below it, so a trie of
    height h takes log2(h) rounds. Sums are combined before they are shuffled, so a node with very many children is no hot key.
    """
    sums = ("n", "leaves", "weight", "chars")
    nodes = nodes.withColumn("up", F.col("parent"))
    while not nodes.where("up is not null").isEmpty():
        got = nodes.where("up is not null").groupBy(F.col("up").alias("id")).agg(
            F.min("low").alias("got_low"), *[F.sum(c).alias(f"got_{c}") for c in sums])
        further = nodes.where("up is not null").select(F.col("id").alias("up"), F.col("up").alias("further"))
        nodes = nodes.join(got, "id", "left").withColumns(
            {"low": F.least("low", "got_low"), **{c: F.col(c) + F.coalesce(f"got_{c}", F.lit(0)) for c in sums}}).drop(
            "got_low", *[f"got_{c}" for c in sums])
        nodes = written(nodes.join(further, "up", "left").drop("up").withColumnRenamed("further", "up"), "subtrees")
    return nodes.drop("up")


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the strings of each end, which come in order; one hash state is held, never a list."""
    last, state = None, None
    for batch in batches:
        done = []
        for end, text in zip(batch["end"], batch["text"], strict=True):
            if end != last:
                if state is not None:
                    done.append((last, state.hexdigest()))
                last, state = end, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if done:
            yield pd.DataFrame(done, columns=["end", "sha"])
    if state is not None:
        yield pd.DataFrame([(last, state.hexdigest())], columns=["end", "sha"])


def prefix_trie(turns: DataFrame, convs: DataFrame, batches: tuple[int, ...] = (1, 8)) -> DataFrame:
    """A row for every distinct sequence that begins a conversation, from the empty one (depth 0).

    ``turns``: ``conv``, ``place`` (from 1, without gaps), ``symbol``, ``chars``; ``convs``: every ``conv`` once, with or without
    turns. Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. Equal conversations are inserted once and counted by their number. ``batches``: growing
    bounds on a hash from 0 to the last bound; a batch is what lies below its bound and was not inserted before.

    Nothing is gathered by conversation or node: prefixes, searches, forks and sums are joins and aggregates. Texts may be of any
    length, only their hashes move. Conversations without turns end at the root. Columns other than those named are not read.
    Without conversations there is no root, and the result is empty.
    """
    known = prefixes(turns)
    last = known.groupBy("conv").agg(F.max("depth").alias("n"), F.max_by("id", "depth").alias("end"))
    ends = written(convs.join(last, "conv", "left").select(
        "conv", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("end", F.lit(ROOT)).alias("end")), "ends")
    parts = ends.groupBy("end", F.floor(F.col("conv") / RANGE).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("text"))
    hashes = parts.repartition("end").sortWithinPartitions("end", "part").mapInPandas(_listed, "end string, sha string")
    kinds = ends.groupBy("end").agg(F.min("conv").alias("conv"), F.first("n").alias("n"), F.count("*").alias("copies"))
    kinds = written(kinds.join(hashes, "end"), "kinds")
    spot = F.pmod(F.xxhash64("end"), F.lit(batches[-1]))
    nodes, low = None, 0
    for high in batches:
        batch = kinds.where((F.col("n") > 0) & (spot >= low) & (spot < high)).select("conv", "n", "end")
        if not batch.isEmpty():
            nodes = _inserted(batch, nodes, known)
        low = high
    root = kinds.groupBy().agg(F.count("*").alias("any")).where("any > 0").select(
        F.lit(ROOT).alias("id"), F.lit(0).cast("long").alias("e"), F.lit(0).cast("long").alias("cum"), F.lit(0).cast("long").alias("above"))
    empty = F.lit(None)
    root = root.select("id", empty.cast("long").alias("p"), "e", empty.cast("long").alias("rep"), empty.cast("string").alias("parent"), "cum", "above")
    full = root if nodes is None else nodes.drop("first", "handle").unionByName(root)
    kids = full.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
    own = kinds.select(F.col("end").alias("id"), F.col("conv").alias("low"), F.col("copies").alias("n"), "sha")
    full = full.join(kids, "id", "left").join(own, "id", "left").withColumns(
        {"kids": F.coalesce("kids", F.lit(0)), "n": F.coalesce("n", F.lit(0)), "edge": F.col("cum") - F.col("above")})
    full = written(full.withColumns({"leaves": (F.col("kids") == 0).cast("long"), "weight": F.col("n") * F.col("cum"), "chars": F.col("edge")})
                   .withColumnsRenamed({"cum": "end_cum"}), "compacted")
    nodes = _subtrees(full).withColumnRenamed("chars", "below")
    # every node with its parent's first member, then a row for each depth of its edge
    nodes = nodes.join(nodes.select(F.col("id").alias("parent"), F.col("low").alias("parent_low")), "parent", "left")
    nodes = written(nodes, "nodes")
    steps = known.select(F.col("conv").alias("rep"), "depth", "cum", "chars")
    rows = nodes.join(steps, "rep").where("depth > p and depth <= e").unionByName(nodes.where("p is null").select(
        "*", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("cum"), F.lit(0).cast("long").alias("chars")))
    at_end, before = F.col("depth") == F.col("e"), F.col("cum") - F.col("chars")
    return rows.select(
        F.col("low").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("p") + 1, F.col("parent_low")).when(F.col("depth") > 0, F.col("low")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(at_end, F.col("kids")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        # over the subtree: members times code points, less the code points once
        (F.col("weight") - F.col("n") * before - (F.col("below") - F.col("edge") + F.col("end_cum") - before)).alias("saved_tokens"),
        F.coalesce(F.when(at_end, F.col("sha")), F.lit(EMPTY_SHA256)).alias("ends_sha256"))
