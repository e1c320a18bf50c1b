"""SimHash fingerprints and near-duplicate groups by a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow.llm.common import components, forest, written

#: Shingles hashed at once, and fingerprints of one posting compared in one task.
CHUNK, POSTING = 1 << 16, 2048


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bit of the XXH64 values (seed 42) of all word shingles, as a signed 64-bit integer; 0 without words."""
    words = (text or "").encode().lower().split()  # splits at the six ASCII white space characters only
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    hash_of, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for low in range(0, n, CHUNK):
        high = min(n, low + CHUNK)
        spans = zip(starts[low:high].tolist(), ends[low + width - 1:high + width - 1].tolist(), strict=True)
        values = np.fromiter((hash_of(joined[a:b], 42) for a, b in spans), dtype=np.uint64, count=high - low)
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``key``, ``mark`` (hash of the text), ``fp`` for every document. Null, empty and blank texts have fingerprint 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array((fingerprint(t.as_py(), shingle) for t in batch["text"]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["key"], batch["mark"], found], ["key", "mark", "fp"])

    return docs.select(F.col(key).cast("long").alias("key"), _mark(F.col(text)).alias("mark"),
                       F.col(text).alias("text")).mapInArrow(run, "key long, mark long, fp long")


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def covering_triples() -> list[tuple[int, int, int]]:
    """20 triples of the 8 byte positions such that any 4 positions contain one of them.

    The positions are dealt to three parts in a ring; a triple lies in one part, or has two
    positions in a part and one in the next. Four positions always hold such a triple.
    """
    parts = ((0, 1, 2), (3, 4, 5), (6, 7))
    whole = [t for p in parts for t in combinations(p, 3)]
    return whole + [(*two, one) for p, after in zip(parts, parts[1:] + parts[:1], strict=True)
                    for two in combinations(p, 2) for one in after]


def _mask(positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >= 1 << 63 else value


def _linked(fp: np.ndarray, starts: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within postings that lie one after the other in fp; each node to the smallest index it reaches."""
    sizes = np.diff(np.append(starts, len(fp)))
    left = np.repeat(starts + sizes, sizes) - np.arange(len(fp))  # members of the posting from here on
    unsigned, found = fp.view(np.uint64), []
    at = np.flatnonzero(left > 1)
    for step in range(1, int(sizes.max(initial=1))):
        at = at[left[at] > step]
        differ = unsigned[at] ^ unsigned[at + step]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # tally of shared positional bytes
        near = shared >= 8 - distance
        near[near] = np.bitwise_count(differ[near]) <= distance
        found.append(np.stack((at[near], at[near] + step)))
    pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), dtype=np.int64)
    nodes = np.unique(pairs)
    if not len(nodes):
        return fp[:0], fp[:0]
    a, b = np.searchsorted(nodes, pairs)
    root = forest(len(nodes), a, b)
    other = root != np.arange(len(nodes))
    return fp[nodes[other]], fp[nodes[root[other]]]


def _scan_postings(batches: Iterator[pd.DataFrame], distance: int, limit: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by posting. Yields links (a, b), or (a, null) for each member of a posting above the limit."""
    index, post, fp = (np.empty(0, dtype=t) for t in (np.int32, np.int64, np.int64))
    long_posting = None

    def links() -> pd.DataFrame:
        starts = np.flatnonzero(np.append(True, (index[1:] != index[:-1]) | (post[1:] != post[:-1])))
        a, b = _linked(fp, starts, distance)
        return pd.DataFrame({"a": a, "b": pd.array(b, dtype="Int64")})

    def members(of: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"a": of, "b": pd.array([None] * len(of), dtype="Int64")})

    for batch in batches:
        i, p, f = (batch[c].to_numpy() for c in ("index", "post", "fp"))
        if long_posting is not None:
            same = (i == long_posting[0]) & (p == long_posting[1])
            yield members(f[same])
            i, p, f = i[~same], p[~same], f[~same]
            if not len(i):
                continue
            long_posting = None
        index, post, fp = np.append(index, i), np.append(post, p), np.append(fp, f)
        if not len(index):
            continue
        changes = np.flatnonzero((index[1:] != index[:-1]) | (post[1:] != post[:-1])) + 1
        bounds = np.concatenate(([0], changes, [len(index)]))
        sizes, rest = np.diff(bounds), (index[bounds[-2]:], post[bounds[-2]:], fp[bounds[-2]:])
        over = np.repeat(sizes > limit, sizes)
        if over.any():
            yield members(fp[over])
        done = ~over
        done[bounds[-2]:] = False
        index, post, fp = index[done], post[done], fp[done]
        if len(index):
            yield links()
        if len(rest[0]) > limit:
            long_posting = (rest[0][0], rest[1][0])
            rest = tuple(x[:0] for x in rest)
        index, post, fp = rest
    if len(index):
        yield links()


def _ball_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links that connect what lies within the distance, without comparing pairs.

    Two fingerprints at d bits meet at a middle value d // 2 flips from one and d - d // 2 flips
    from the other. All that reach a middle value with d // 2 flips lie within d of each
    other, so each links to the smallest of them; so does each that needs one flip more.
    """
    near, far = distance // 2, distance - distance // 2
    flips = [(sum(1 << b for b in bits), k > near) for k in range(far + 1) for bits in combinations(range(64), k)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m, _ in flips]
    reach = fps.select("fp", F.posexplode(F.lit(signed).cast("array<long>"))).select(
        "fp", F.col("fp").bitwiseXOR(F.col("col")).alias("mid"),
        (F.col("pos") >= sum(not outer for _, outer in flips)).alias("outer"))
    low = reach.where("not outer").groupBy("mid").agg(F.min("fp").alias("low"))
    return reach.join(low, "mid").where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def near_links(fps: DataFrame, distance: int = 4, limit: int = POSTING) -> DataFrame:
    """Links ``a``, ``b`` whose components are those of all pairs within the distance; ``fps`` holds distinct ``fp``.

    Pairs at ``distance`` or fewer bits share at least 8 - distance of their 8 positional bytes, and
    four shared positions hold one of the covering triples. So the index posts every fingerprint
    under its bytes at each triple; within a posting the shared bytes of pairs are tallied,
    pairs with the guaranteed minimum are kept and their bits counted. A posting's links are
    reduced to a forest before they leave the task. The members of a posting above ``limit`` (near copies
    share all their bytes) are linked through middle values instead, which needs no pairs.
    """
    if not 0 <= distance <= 4:
        raise ValueError("the index guarantees matches up to 4 bits")
    masks = [_mask(t) for t in covering_triples()]
    posts = F.array(*[F.struct(F.lit(i).alias("index"), F.col("fp").bitwiseAND(F.lit(m)).alias("post"))
                      for i, m in enumerate(masks)])
    posted = fps.select("fp", F.explode(posts).alias("at")).select("at.index", "at.post", "fp")
    posted = posted.repartition("index", "post").sortWithinPartitions("index", "post")
    found = written(posted.mapInPandas(lambda b: _scan_postings(b, distance, limit), "a long, b long"), "posting-links")
    links = found.where("b is not null").distinct()
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    return links if crowded.isEmpty() else links.union(_ball_links(crowded, distance)).distinct()


def _groups(docs: DataFrame, key: str, text: str, shingle: int, distance: int, limit: int) -> DataFrame:
    """``key``, ``mark`` (hash of the text), ``fp``, ``root`` (a fingerprint) and ``component``, a row per document."""
    prints = written(fingerprints(docs, key, text, shingle), "fingerprints")
    first = written(prints.groupBy("fp").agg(F.min("key").alias("first")), "distinct-fingerprints")
    roots = written(components(near_links(first.select("fp"), distance, limit)), "fingerprint-roots")
    linked = first.join(roots, first["fp"] == roots["node"]).select("fp", "first", "root")
    names = linked.groupBy("root").agg(F.min("first").alias("name"))
    renamed = linked.select("fp", "root").join(names, "root").select(F.col("fp").alias("p"), "root", "name")
    own = first.join(renamed, first["fp"] == renamed["p"], "left").select(
        F.col("fp").alias("print"), F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("name")).alias("component"))
    return prints.join(own, prints["fp"] == own["print"]).drop("print")


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
                   distance: int = 4, limit: int = POSTING) -> DataFrame:
    """``key``, ``fp`` (long) and ``component`` (smallest key reachable by links) for every document.

    Equal fingerprints collapse to one before the search, so copies cost nothing. Null, empty
    and blank texts have fingerprint 0 and link like any other. Repeated rows stay separate rows. A component
    without any key but null has a null name. An empty table gives an empty result. Other
    columns are ignored. Very long texts are hashed in chunks.
    """
    return _groups(docs, key, text, shingle, distance, limit).select("key", "fp", "component")


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
                  distance: int = 4) -> DataFrame:
    """One document of each group, with all its columns: that with the smallest key.

    Where rows repeat that key, the one whose text and then whose columns have the smallest hash
    stays. Edge cases are those of ``simhash_groups``.
    """
    groups = _groups(docs, key, text, shingle, distance, POSTING).where("key <=> component")
    keep = groups.groupBy("root").agg(F.min(F.struct("key", "mark")).alias("of")).select(
        "root", F.col("of.key").alias("k"), F.col("of.mark").alias("m"))
    plain = [F.col(f"`{f.name}`") for f in docs.schema if not f.dataType.simpleString().startswith(("map", "variant"))]
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("key"),
                       _mark(F.col(text)).alias("mark"), F.xxhash64(*plain).alias("turn"))
    kept = rows.join(keep, rows["key"].eqNullSafe(keep["k"]) & (rows["mark"] == keep["m"]))
    return kept.groupBy("root").agg(F.min_by("row", "turn").alias("row")).select("row.*")
