"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerflow.llm.common import components, forest, written

#: Rows of one side that a task compares at once, and rows of a group that is compared together with others.
BLOCK, FEW = 2048, 128


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, scaled to keep lengths; the width is a power of two."""
    n, width, half = len(x), x.shape[1], 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        half *= 2
    return x.reshape(n, width) / np.sqrt(width)


def bucket_keys(unit: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """``tables * probes`` bucket keys of every unit vector.

    A hash turns a vector three times by random signs and a Hadamard transform; the nearest corner of the
    cross-polytope is the largest coordinate with its sign. A bucket of a table is ``hashes`` corners. Its
    probes swap in the second nearest corners, those first that lose least.
    """
    n, dim = unit.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    random, rows, keys = np.random.default_rng(seed), np.arange(n), np.empty((n, tables * probes), dtype=np.int64)
    swaps = np.array(list(product((0, 1), repeat=hashes)))
    for t in range(tables):
        corners = np.empty((n, hashes, 2), dtype=np.int64)
        losses = np.empty((n, hashes))
        for h in range(hashes):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * random.choice((-1.0, 1.0), width))
            size = np.abs(turned)
            two = np.argpartition(-size, 1, axis=1)[:, :2]
            two = np.take_along_axis(two, np.argsort(-np.take_along_axis(size, two, 1), axis=1, kind="stable"), 1)
            top = np.take_along_axis(size, two, 1)
            corners[:, h] = 2 * two + (np.take_along_axis(turned, two, 1) < 0)
            losses[:, h] = top[:, 0] - top[:, 1]
        chosen = np.argsort((losses ** 2) @ swaps.T, axis=1, kind="stable")[:, :probes]
        for p in range(probes):
            code = np.full(n, t, dtype=np.int64)
            for h in range(hashes):
                code = code * (2 * width) + corners[rows, h, swaps[chosen[:, p], h]]
            keys[:, t * probes + p] = code
    keys.sort(axis=1)
    return keys


def _units(vectors) -> np.ndarray:
    """Rows of length one; shorter vectors are filled up with zeros."""
    given = [np.asarray(v, dtype=np.float64) for v in vectors]
    width = max(len(v) for v in given)
    x = np.stack([v if len(v) == width else np.pad(v, (0, width - len(v))) for v in given])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _near_pairs(unit: np.ndarray, group: pd.DataFrame, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row places with a cosine of the threshold or more, inside groups that lie one after the other.

    Groups of few rows are compared all at once, each row with the next one, the one after it and so on; larger ones by a
    matrix product each.
    """
    names = group[["key", "low", "high"]].to_numpy()
    starts = np.flatnonzero(np.append(True, (names[1:] != names[:-1]).any(axis=1)))
    sizes = np.diff(np.append(starts, len(names)))
    few = (sizes <= FEW) & (names[starts, 1] == names[starts, 2])
    left = np.where(np.repeat(few, sizes), np.repeat(starts + sizes, sizes) - np.arange(len(names)), 0)
    found, at = [], np.flatnonzero(left > 1)
    for step in range(1, int(sizes[few].max(initial=1))):
        at = at[left[at] > step]
        for low in range(0, len(at), 1 << 15):
            i = at[low:low + (1 << 15)]
            near = np.einsum("ij,ij->i", unit[i], unit[i + step]) >= threshold
            found.append(np.stack((i[near], i[near] + step)))
    block = group["block"].to_numpy()
    for start, size in zip(starts[~few], sizes[~few], strict=True):
        rows = np.arange(start, start + size)
        a, b = (rows[block[rows] == names[start, side]] for side in (1, 2))
        i, j = np.nonzero(unit[a] @ unit[b].T >= threshold)
        i, j = a[i], b[j]
        once = i < j if names[start, 1] == names[start, 2] else np.full(len(i), True)
        found.append(np.stack((i[once], j[once])))
    i, j = np.concatenate(found, axis=1) if found else np.empty((2, 0), dtype=np.int64)
    return i, j


def _compare(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links inside whole groups: (uid, null, links of uid found here) and a forest (uid, uid, 0).

    A group is a bucket, or two blocks of one. A pair that shares several buckets counts in the smallest only.
    """
    uid, copies, key = (group[c].to_numpy() for c in ("uid", "copies", "key"))
    i, j = _near_pairs(_units(group["vector"]), group, threshold)
    if not len(i):
        return pd.DataFrame({"a": uid[:0], "b": pd.array([], dtype="Int64"), "n": uid[:0]})
    keys, first = np.stack(group["keys"]), np.empty(len(i), dtype=bool)
    for at in range(0, len(i), 8192):
        a, b = keys[i[at:at + 8192]], keys[j[at:at + 8192]]
        shared = (a[:, :, None] == b[:, None, :]).any(axis=2)
        first[at:at + 8192] = np.where(shared, a, np.iinfo(np.int64).max).min(axis=1) == key[i[at:at + 8192]]
    names, place = np.unique(uid, return_inverse=True)
    i, j, stands_for = place[i[first]], place[j[first]], np.empty(len(names))
    stands_for[place] = copies
    links = np.bincount(i, weights=stands_for[j], minlength=len(names)) + np.bincount(j, weights=stands_for[i], minlength=len(names))
    some = np.flatnonzero(links)
    root = forest(len(names), i, j)
    child = np.flatnonzero(root != np.arange(len(names)))
    return pd.DataFrame({
        "a": np.concatenate((names[some], names[child])),
        "b": pd.array([None] * len(some) + names[root[child]].tolist(), dtype="Int64"),
        "n": np.concatenate((links[some].astype(np.int64), np.zeros(len(child), dtype=np.int64)))})


def _scan_buckets(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Rows sorted by (key, low, high); a group is at most two blocks, and a call compares at most a batch and one group."""
    names, rest = ["key", "low", "high"], None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rest is None else pd.concat((rest, batch), ignore_index=True)
        last = (rows[names] == rows[names].iloc[-1]).all(axis=1).to_numpy()
        begins = int(np.argmax(last))
        if begins:
            yield _compare(rows.iloc[:begins], threshold)
        rest = rows.iloc[begins:]
    if rest is not None:
        yield _compare(rest, threshold)


def vector_groups(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                  tables: int = 10, hashes: int = 3, probes: int = 4, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """``key``, ``n_links`` and ``component`` (smallest key reachable by links) for every vector.

    Equal vectors collapse to one that stands for its copies. Every vector is indexed under its buckets; buckets with one member are
    dropped before vectors move. A bucket above ``block`` members is cut into blocks, every two of which
    meet in a task of their own. All candidates are verified by the cosine in double precision; the
    links found are exact, and how many are found depends on the hash parameters (``index_recall``
    in the tests). Vectors of different dimension never link.

    Null and zero vectors and those with null or non-finite components link with nothing and are components of
    their own. Repeated rows are separate vectors. A component without any key but null has a null name. Other
    columns are ignored. An empty table gives an empty result.
    """
    value = F.col("vector")
    usable = F.coalesce(value.isNotNull() & (F.size(value) > 0)
                        & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                        & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("usable", usable).withColumn("h", F.xxhash64("vector")).withColumn("g", F.hash("vector"))
    good = rows.where("usable").groupBy("h", "g").agg(
        F.min("key").alias("first"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            for size, part in batch.groupby(batch["vector"].map(len)):
                found = bucket_keys(_units(part["vector"]), tables, hashes, probes, seed)
                found = found ^ (np.int64(size) << 52)  # vectors of other dimensions live in other buckets
                found.sort(axis=1)
                keys.loc[part.index] = list(found)
            yield batch.assign(keys=keys)

    kept = written(good.mapInPandas(
        keyed, "h long, g int, first long, copies long, vector array<double>, keys array<long>")
        .withColumn("uid", F.monotonically_increasing_id()), "distinct-vectors")
    posted = kept.select("uid", F.explode("keys").alias("key"))
    crowded = posted.groupBy("key").agg(F.ceil(F.count("*") / block).alias("blocks"), F.count("*").alias("n")).where("n > 1")
    live = posted.join(crowded.drop("n"), "key").withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")))
    meet = live.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "uid")
    ready = meet.join(kept.select("uid", "copies", "vector", "keys"), "uid")
    ready = ready.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    found = written(ready.mapInPandas(lambda b: _scan_buckets(b, threshold), "a long, b long, n long"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "uid")
    named = kept.select("uid", "h", "g", "first", "copies").join(counts, "uid", "left").join(roots, "uid", "left")
    named = named.withColumn("root", F.coalesce("root", "uid"))
    names = named.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component"))
    named = named.join(names, F.col("root") == F.col("r")).select(
        "h", "g", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component")
    alone = rows.where("not usable").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component"))
    return rows.where("usable").select("key", "h", "g").join(named, ["h", "g"]).select("key", "n_links", "component") \
        .unionByName(alone)
