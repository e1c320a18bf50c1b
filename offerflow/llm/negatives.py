"""Hard negatives: rotated one-bit codes give an interval for every inner product, and integers decide inside it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerflow.llm.common import written
from offerflow.llm.embeddings import hadamard

#: Integers up to here are exact as doubles.
EXACT = float(1 << 53)


@dataclass(frozen=True)
class Mining:
    """Parameters; only ``positives`` to ``high`` change the result, the others how much work it takes."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: float = 256.0
    levels: int = 5
    bits: int = 6
    seed: int = 11
    rows: int = 4096
    anchors: int = 512


def _width(dim: int) -> int:
    return max(64, 1 << (dim - 1).bit_length())


def _record(dim: int, levels: int) -> np.dtype:
    """What is stored of a vector: integers, code words and alignments of each level, length of the rest and of the whole."""
    return np.dtype([("x", "<f8", (dim,)), ("code", "<u8", (levels, _width(dim) // 64)), ("align", "<f8", (levels,)),
                     ("rest", "<f8"), ("norm", "<f8")])


def _turn(x: np.ndarray, level: int, seed: int) -> np.ndarray:
    """The rotation of a level: three times random signs and a Hadamard transform."""
    random = np.random.default_rng((seed, level))
    for _ in range(3):
        x = hadamard(x * random.choice((-1.0, 1.0), x.shape[1]))
    return x


def encode(x: np.ndarray, levels: int, seed: int) -> np.ndarray:
    """Records of integer vectors.

    A level rotates what is left of a vector, keeps the sign of every coordinate as its code, and stores the alignment
    of the vector with the unit vector of that code. What the code vector explains is taken off; the next level codes the rest.
    """
    n, dim = x.shape
    out, width = np.zeros(n, _record(dim, levels)), _width(dim)
    out["x"], out["norm"] = x, np.sqrt((x * x).sum(axis=1))
    left = np.zeros((n, width))
    left[:, :dim] = x
    for level in range(levels):
        left = _turn(left, level, seed)
        sign = left >= 0
        out["code"][:, level] = np.packbits(sign, axis=1, bitorder="little").view("<u8")
        align = np.abs(left).sum(axis=1) / np.sqrt(width)
        out["align"][:, level] = align
        left -= np.where(sign, 1.0, -1.0) * (align / np.sqrt(width))[:, None]
    out["rest"] = np.sqrt((left * left).sum(axis=1))
    return out


class Anchors:
    """Anchors turned by every level and cut into bit planes, so that popcounts give their product with a code vector."""

    def __init__(self, x: np.ndarray, bits: int, levels: int, seed: int) -> None:
        n, dim = x.shape
        self.width, self.bits, self.levels = _width(dim), bits, levels
        self.planes = np.zeros((levels, bits, n, self.width // 64), dtype=np.uint64)
        self.low, self.step, self.sum, self.error = (np.zeros((levels, n)) for _ in range(4))
        self.norm = np.sqrt((x * x).sum(axis=1))
        turned = np.zeros((n, self.width))
        turned[:, :dim] = x
        for level in range(levels):
            turned = _turn(turned, level, seed)
            low = turned.min(axis=1)
            step = (turned.max(axis=1) - low) / ((1 << bits) - 1)
            k = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1.0)[:, None]).astype(np.int64)
            near = low[:, None] + step[:, None] * k
            for bit in range(bits):
                plane = np.packbits((k >> bit & 1).astype(bool), axis=1, bitorder="little")
                self.planes[level, bit] = plane.view("<u8")
            self.low[level], self.step[level], self.sum[level] = low, step, near.sum(axis=1)
            self.error[level] = np.sqrt(((turned - near) ** 2).sum(axis=1))

    def intervals(self, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products of some anchors with all rows.

        Popcounts give the anchor's product with each code vector but for the rounding of its planes. By
        Cauchy-Schwarz that rounding moves a level by at most alignment times the length of the rounding error,
        and what no level explains adds at most its length times the anchor's. Both are certain, not likely.
        """
        n, root = len(rows), np.sqrt(self.width)
        middle, reach = np.empty((len(at), n)), np.outer(self.norm[at], rows["rest"]) + self.error[:, at].T @ rows["align"].T
        codes = np.ascontiguousarray(rows["code"].transpose(1, 2, 0))
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        align = np.ascontiguousarray(rows["align"].T)
        shared, hits = np.empty(n, dtype=np.uint64), np.empty(n, dtype=np.uint8)
        count = np.empty(n, dtype=np.uint16 if self.width << self.bits < 1 << 16 else np.uint64)
        for i, a in enumerate(at):
            found = middle[i]
            found[:] = 0.0
            for level in range(self.levels):
                count[:] = 0
                for bit in range(self.bits - 1, -1, -1):
                    count <<= 1
                    for word, plane in enumerate(self.planes[level, bit, a]):
                        np.bitwise_and(codes[level, word], plane, out=shared)
                        count += np.bitwise_count(shared, out=hits)
                # half the product of the code vector with the anchor's rounded coordinates, times the root of the width
                half = self.step[level, a] * count + self.low[level, a] * ones[level]
                half -= self.sum[level, a] / 2
                half *= align[level]
                found += half * (2.0 / root)
        reach += 1e-9 * np.outer(self.norm[at], rows["norm"]) + 1e-9  # rounding of doubles
        return middle - reach, middle + reach


def _scores(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of rows with one vector; beyond 64 bits they stay at the limit."""
    if len(rows) and np.abs(rows).max() * np.abs(x).max() * len(x) >= EXACT:
        whole = np.array([[int(v) for v in r] for r in rows], dtype=object) @ np.array([int(v) for v in x], dtype=object)
        info = np.iinfo(np.int64)
        return np.array([min(max(int(v), info.min), info.max) for v in whole], dtype=np.int64)
    return np.rint(rows @ x).astype(np.int64)


def _first(score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by falling score, then rising key."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
        return some[np.lexsort((key[some], -score[some]))[:k]]
    return np.lexsort((key, -score))[:k]


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity where a row has fewer."""
    n = values.shape[1]
    return np.partition(values, n - k, axis=1)[:, n - k] if n >= k else np.full(len(values), -np.inf)


def _groups(anchors: pd.DataFrame, rows: pd.DataFrame, dim: int, m: Mining) -> Iterator[tuple]:
    """For each label of the anchors, chunks of its anchors with the rows of that label (and of all others)."""
    kind = _record(dim, m.levels)
    label = rows["label"].to_numpy()
    order = np.argsort(label, kind="stable")
    label, key, uid = (rows[c].to_numpy()[order] for c in ("label", "key", "uid"))
    body = np.frombuffer(b"".join(rows["body"].to_numpy()[order]), dtype=kind)
    queries = np.frombuffer(b"".join(anchors["body"]), dtype=kind)["x"]
    turned = Anchors(queries, m.bits, m.levels, m.seed)
    own = anchors["label"].to_numpy()
    for name in np.unique(own):
        begin, end = np.searchsorted(label, name), np.searchsorted(label, name, side="right")
        at = np.flatnonzero(own == name)
        for low in range(0, len(at), 32):
            yield turned, queries, at[low:low + 32], slice(begin, end), body, key, uid


def _positives(anchors: pd.DataFrame, rows: pd.DataFrame, dim: int, m: Mining) -> pd.DataFrame:
    """The first rows of the same label in one block, for each anchor of one block."""
    found, names, keys = [], anchors["uid"].to_numpy(), anchors["key"].to_numpy()
    for turned, queries, at, same, body, key, uid in _groups(anchors, rows, dim, m):
        body, key, uid = body[same], key[same], uid[same]
        if not len(body):
            continue
        low, high = turned.intervals(at, body)
        self = keys[at][:, None] == key[None, :]
        low[self] = high[self] = -np.inf
        alive = (high >= _kth(low, m.positives)[:, None]) & ~self
        for i, a in enumerate(at):
            some = np.flatnonzero(alive[i])
            score = _scores(body["x"][some], queries[a])
            best = _first(score, key[some], m.positives)
            found += [(int(names[a]), int(key[j]), int(uid[j]), int(s)) for j, s in zip(some[best], score[best], strict=True)]
    return pd.DataFrame(found, columns=["anchor", "key", "uid", "score"])


def _negatives(anchors: pd.DataFrame, rows: pd.DataFrame, dim: int, m: Mining) -> pd.DataFrame:
    """The first rows of other labels in one block inside the window of each positive, for each anchor of one block."""
    found, names, wanted = [], anchors["uid"].to_numpy(), anchors["scores"].to_numpy()
    for turned, queries, at, same, body, key, uid in _groups(anchors, rows, dim, m):
        others = np.r_[0:same.start, same.stop:len(body)]
        if not len(others):
            continue
        body, key, uid = body[others], key[others], uid[others]
        low, high = turned.intervals(at, body)
        for i, a in enumerate(at):
            bounds = [(-(-m.low * int(s) // 100), m.high * int(s) // 100) for s in wanted[a]]
            alive = np.zeros(len(body), dtype=bool)
            for least, most in bounds:
                if least > most:
                    continue
                inside = (high[i] >= least) & (low[i] <= most)
                sure = np.where((low[i] >= least) & (high[i] <= most), low[i], -np.inf)
                alive |= inside & (high[i] >= _kth(sure[None, :], m.negatives)[0])
            some = np.flatnonzero(alive)
            score = _scores(body["x"][some], queries[a])
            for place, (least, most) in enumerate(bounds):
                fit = np.flatnonzero((score >= least) & (score <= most))
                best = fit[_first(score[fit], key[some[fit]], m.negatives)]
                found += [(int(names[a]), place, int(key[some[j]]), int(uid[some[j]]), int(score[j])) for j in best]
    return pd.DataFrame(found, columns=["anchor", "place", "key", "uid", "score"])


def hard_negatives(vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                   mining: Mining = Mining()) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A component x counts as floor(scale * x), a score is the integer inner product; higher scores come first, ties by
    smaller key. The positives of an anchor are the first rows of its label; a negative of a positive is a row of another label whose
    score is from ``low`` to ``high`` per cent of the positive's. ``is_anchor`` is a condition on the columns of ``vectors``.

    Every anchor meets every row, in blocks: a task holds one block of anchors and one of rows, both of bounded size and cut by
    a hash of the whole row, so no key, label or group of copies makes a block larger. In a task popcounts give an interval for
    each product; a row is dropped only if its interval shows that it cannot be among the first of its block, and integers
    decide among the rest. So the result is exact for any parameters.

    Rows with a null key, label or vector, or a null or non-finite component, take no part. Identical rows count once; rows
    that share a key but differ are rows of their own, though none is positive to its own key. Vectors of unequal length are filled up
    with zeros. Scores beyond 64 bits stay at the limit. Extra columns are ignored. An empty table gives an empty result.
    """
    spark, m = vectors.sparkSession, mining
    value = F.col("vector")
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"), is_anchor.alias("is_anchor"))
    rows = rows.where(F.col("key").isNotNull() & F.col("label").isNotNull() & value.isNotNull()
                      & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).distinct()
    dim = rows.agg(F.max(F.size("vector"))).first()[0] or 1

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.zeros((len(batch), dim))
            for i, v in enumerate(batch.pop("vector")):
                x[i, :len(v)] = v
            whole = encode(np.floor(m.scale * x), m.levels, m.seed)
            yield batch.assign(body=[r.tobytes() for r in whole])

    rows = rows.withColumn("spot", F.xxhash64("key", "label", "vector")).select("key", "label", "is_anchor", "spot", "vector")
    stored = written(rows.mapInPandas(encoded, "key long, label long, is_anchor boolean, spot long, body binary")
                     .withColumn("uid", F.monotonically_increasing_id()), "coded-vectors")
    n, n_anchors = stored.agg(F.count("*"), F.count_if("is_anchor")).first()
    row_blocks, anchor_blocks = max(1, -(-n // m.rows)), max(1, -(-n_anchors // m.anchors))

    def met(queries: DataFrame, schema: str, function) -> DataFrame:
        """Every block of anchors with every block of rows."""
        # new names for all columns: both sides stem from one table
        left = queries.select(*[F.col(c).alias(c) for c in queries.columns]).withColumn("a", F.pmod("spot", F.lit(anchor_blocks))).withColumn(
            "r", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)).cast("array<long>")))
        right = stored.select(*[F.col(c).alias(c) for c in ("key", "label", "uid", "body")], F.pmod(F.shiftright("spot", 20), F.lit(row_blocks)).alias("r")).withColumn(
            "a", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)).cast("array<long>")))
        return left.groupBy("a", "r").cogroup(right.groupBy("a", "r")).applyInPandas(
            lambda x, y: function(x, y, dim, m), schema)

    queries = stored.where("is_anchor").select("key", "label", "uid", "spot", "body")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "key", "uid")
    positives = met(queries, "anchor long, key long, uid long, score long", _positives)
    positives = written(positives.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < m.positives), "positives")
    wanted = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("found"))
    queries = queries.join(wanted, F.col("uid") == F.col("anchor")).select(
        "key", "label", "uid", "spot", "body", F.col("found.score").alias("scores"))
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "key", "uid")
    negatives = met(queries, "anchor long, place int, key long, uid long, score long", _negatives).withColumn(
        "rank", F.row_number().over(first)).where(F.col("rank") <= m.negatives)
    negatives = negatives.select("anchor", "place", "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    named = positives.select("anchor", "place", F.col("key").alias("positive_id"), F.col("score").alias("positive_score")).join(
        stored.where("is_anchor").select(F.col("uid").alias("anchor"), F.col("key").alias("anchor_id")), "anchor")
    return named.join(negatives, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
