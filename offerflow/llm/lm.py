"""Language-model scores: a probabilistic suffix tree over words, learned and applied on Spark.

Tokens are the words of a text with A-Z in lower case, then one end token. A state of the tree is a context of up to
``depth`` words that occurs often enough and whose next-token distribution differs enough from that of its longest kept
suffix. Distributions are smoothed by absolute discounting: what a state takes off its counts goes to its
suffix, and at the root every token counts once more than it was seen, with one more token for all unseen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow.llm.common import ranked, written
from offerflow.llm.lm_parts import END, FIRST, RARE, scored_by_parts, tokens_of
from offerflow.workdir import written_alone

#: Characters of texts for each entry up to which goes to tasks, from which on the model is expected to be larger.
EXPECTED = 500
#: Entries that a task counts before it passes them on, and rows it yields at once.
HELD, ROWS = 1 << 19, 1 << 16


@dataclass(frozen=True)
class Settings:
    """``least``: occurrences of a context with its next word to be counted in the tree. ``cutoff``: log likelihood
    a state must win per stored count. ``broadcast``: words, and counts per level, up to which
    the model goes to every task; beyond it the same model is learned and applied by parts (``lm_parts``). ``part``: tokens of coded
    texts that are looked up together there. ``spread``: occurrences from which on continuations of a context are in all buckets."""

    depth: int = 3
    least: int = 10
    discount: float = 0.75
    cutoff: float = 3.0
    broadcast: int = 2_000_000
    part: int = 2 << 20
    spread: int = 1 << 20


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 7 == 2, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` over ``text`` of all given documents; counts are combined in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def passed() -> Iterator[pa.RecordBatch]:
            words, counts = list(found), list(found.values())
            found.clear()
            for low in range(0, len(words), ROWS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.decode() for w in words[low:low + ROWS]], pa.string()), pa.array(counts[low:low + ROWS], pa.int64())],
                    ["word", "n"])

        for batch in batches:
            for value in batch["text"]:
                found.update(tokens_of(value.as_py()))
                if len(found) > HELD:
                    yield from passed()
        yield from passed()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """Counted continuations of contexts of one length, sorted by ``key`` = context * words + next id.

    The context of level 1 is a word id, that of a later level the place of a row in the level before. ``kept`` is a
    state's discounted share of each continuation (0 without a state), ``back`` by context what it leaves to
    its suffix (1 without a state).
    """

    key: np.ndarray
    n: np.ndarray
    kept: np.ndarray = field(default_factory=lambda: np.empty(0))
    back: np.ndarray = field(default_factory=lambda: np.empty(0))
    suffix: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))
    prob: np.ndarray = field(default_factory=lambda: np.empty(0))


def _place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key among sorted keys; -1 where it is missing."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def contexts(ids: np.ndarray, levels: list[Level], words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each level: context of every token (-1: none is counted), and place of the context with the token (-1: rare).

    After the last level follow the contexts of the next one, with no places. Ids of many texts may stand one after the
    other: the end token is no context, so none crosses a text.
    """
    context = np.concatenate(([-1], ids[:-1]))
    context[context < FIRST] = -1
    known = ids != RARE
    for level in levels:
        some = np.flatnonzero((context >= 0) & known)
        place = np.full(len(ids), -1, dtype=np.int64)
        place[some] = _place(level.key, context[some] * words + ids[some])
        yield context, place
        known = place >= 0  # a longer context with this token cannot be frequent where the shorter is not
        context = np.concatenate(([-1], place[:-1]))
        context[np.concatenate(([True], ids[:-1] == END))] = -1
    yield context, known


def _sums(x: np.ndarray, context: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(context, weights=x, minlength=size).astype(float)  # whole numbers if there is nothing to sum


def retain(levels: list[Level], word_n: np.ndarray, total: int, distinct: int, settings: Settings) -> None:
    """Divergence tests, shortest contexts first; fills the levels' shares.

    A context becomes a state if on the training tokens that follow it, its own distribution has a log
    likelihood above that of its longest kept suffix by ``cutoff`` per counted continuation.
    """
    words, root = len(word_n), (word_n + 1.0) / (total + distinct + 1.0)
    before: Level | None = None
    for level in levels:
        context, following = level.key // words, level.key % words
        if before is None:
            size, seen, level.suffix, shorter = words, word_n, following, root[following]
        else:
            size, seen = len(before.key), before.n
            of = before.suffix[context]  # level 2: a word; later: a place two levels up
            level.suffix = _place(before.key, of * words + following)
            shorter = before.prob[level.suffix]
        share = (level.n - settings.discount) / seen[context]
        back = 1.0 - _sums(share, context, size)
        own = share + back[context] * shorter
        gain = _sums(level.n * np.log(own / shorter), context, size)
        rest = seen - _sums(level.n, context, size)
        edges = _sums(np.ones(len(context)), context, size)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain += np.where(rest > 0, rest * np.log(back), 0.0)
        state = (edges > 0) & (gain >= settings.cutoff * edges)
        level.back, level.kept = np.where(state, back, 1.0), np.where(state[context], share, 0.0)
        level.prob = np.where(state[context], own, shorter)
        before = level


def log10_scores(ids: np.ndarray, levels: list[Level], root: np.ndarray) -> np.ndarray:
    """log10 probability of every token; for a rare one without its probability at the root."""
    prob = np.where(ids == RARE, 1.0, root[ids])
    for level, (context, place) in zip(levels, contexts(ids, levels, len(root)), strict=False):
        inside = context >= 0
        prob[inside] *= level.back[context[inside]]
        counted = place >= 0
        prob[counted] += level.kept[place[counted]]
    return np.log10(prob)


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    ids = [np.frombuffer(v.as_buffer(), dtype=np.int32) for v in batch[name]]
    return np.concatenate(ids).astype(np.int64), np.cumsum([0, *(len(i) for i in ids)])


def _continuations(coded: DataFrame, levels: list[Level], words: int, least: int) -> DataFrame:
    """``key``, ``n`` of the next level, over the training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, dtype=np.int64),) * 2

        def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            found, at = np.unique(keys, return_inverse=True)
            return found, np.bincount(at, weights=counts).astype(np.int64)

        def passed() -> Iterator[pa.RecordBatch]:
            for low in range(0, len(held[0]), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(x[low:low + ROWS]) for x in held], ["key", "n"])

        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                ids, _ = _flat(batch.slice(low, 1024), "ids")
                *_, (context, known) = contexts(ids, levels, words)
                some = (context >= 0) & known
                keys, counts = np.unique(context[some] * words + ids[some], return_counts=True)
                held = merged(np.concatenate((held[0], keys)), np.concatenate((held[1], counts)))
                if len(held[0]) > 4 * HELD:
                    yield from passed()
                    held = (held[0][:0], held[1][:0])
        yield from passed()

    counted = coded.where("not held_out").select("ids").mapInArrow(run, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _coded(rows: DataFrame, words: dict[bytes, int]) -> DataFrame:
    """``uid``, ``key``, ``held_out``, ``ids`` (32-bit, with the end token) and the ``rare`` words of each text."""
    given = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = given.value.get
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                ids, rare = [], []
                for value in part["text"]:
                    tokens = tokens_of(value.as_py())
                    coded = [get(w, RARE) for w in tokens]
                    rare.append([w.decode() for w, i in zip(tokens, coded, strict=True) if not i])
                    coded.append(END)
                    ids.append(np.array(coded, dtype=np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["held_out"], pa.array(ids, pa.binary()), pa.array(rare, pa.list_(pa.string()))],
                    ["key", "held_out", "ids", "rare"])

    made = rows.mapInArrow(run, "key long, held_out boolean, ids binary, rare array<string>")
    return written(made.withColumn("uid", F.monotonically_increasing_id()), "coded-texts")


def _scored_in_tasks(coded: DataFrame, rare_words: DataFrame, levels: list[Level], word_n: np.ndarray, total: int, distinct: int) -> DataFrame:
    model = coded.sparkSession.sparkContext.broadcast(([Level(x.key, x.n[:0], x.kept, x.back) for x in levels], word_n))
    size = total + distinct + 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, word_n = model.value
        root, plain = (word_n + 1.0) / size, np.log10(word_n + 1.0)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                ids, bounds = _flat(part, "ids")
                scores = log10_scores(ids, levels, root)
                base = np.where(ids == RARE, 0.0, plain[ids])
                known = (ids != RARE) & (word_n[ids] > 0)
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (scores, base, known.astype(np.int64), ids == RARE)]
                yield pa.RecordBatch.from_arrays(
                    [part["uid"], part["key"], part["held_out"], pa.array(np.diff(bounds)), *map(pa.array, sums[:3]),
                     pa.array(np.add.reduceat((ids == RARE).astype(np.int64), bounds[:-1]))],
                    ["uid", "key", "held_out", "n_tokens", "tree", "plain", "known", "n_rare"])

    heavy = coded.select("uid", "key", "held_out", "ids").mapInArrow(
        run, "uid long, key long, held_out boolean, n_tokens long, tree double, plain double, known long, n_rare long")
    rare = coded.select("uid", F.explode("rare").alias("word")).join(rare_words, "word").groupBy("uid").agg(
        F.sum(F.log10(F.col("n") + 1.0)).alias("rare_plain"), F.count("*").alias("rare_known"))
    found, size_log = heavy.join(rare, "uid", "left"), math.log10(size)
    seen = F.coalesce("rare_plain", F.lit(0.0))
    return found.select(
        "key", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("plain") + seen - F.col("n_tokens") * size_log).alias("base_score"),
        (F.col("tree") + seen - F.col("n_rare") * size_log).alias("score"))


def scores(docs: DataFrame, held: Column | None = None, key: str = "doc_id", text: str = "text",
           settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Learn from the documents that are not held out, score all.

    ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (words independent of each other), ``score``.

    All words of all training texts are counted. Words of ``least`` or more occurrences get ids; contexts are
    counted level by level, each in one pass over the coded texts with counts combined in the task. Rare words are never in
    the tree; their counts meet the texts by a join in which no key is frequent. Vocabulary and tree grow
    with the corpus; they go to tasks only while they are small enough, see ``Settings``.

    Null and empty texts are one end token. Null keys are training texts. Repeated rows count and are scored each. Without
    training texts all scores are 0. Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(held if held is not None else held_out(F.col(key)), F.lit(False)).alias("held_out"),
                       F.col(text).alias("text"))
    sizes = rows.agg(F.sum((~F.col("held_out")).cast("long")), F.sum(F.length("text"))).first()
    ends, characters = (x or 0 for x in sizes)
    if characters > EXPECTED * settings.broadcast:
        return scored_by_parts(rows, ends, settings)
    vocabulary = written_alone(word_counts(rows.where("not held_out")), "word-counts")
    sums = vocabulary.agg(F.sum("n"), F.count("*")).first()
    total, distinct = (sums[0] or 0) + ends, sums[1] + (1 if ends else 0)
    frequent = vocabulary.where(F.col("n") >= settings.least)
    heavy = ranked(frequent, [F.col("n").desc(), F.col("word").asc()], "place").withColumn("id", F.col("place") + FIRST)
    levels: list[Level] = []
    small = heavy.count() <= settings.broadcast
    if small:
        table = heavy.select("word", "id", "n").toArrow().to_pydict()
        words = {w.encode(): i for w, i in zip(table["word"], table["id"], strict=True)}
        word_n = np.zeros(len(words) + FIRST, dtype=np.int64)
        word_n[table["id"]], word_n[END] = table["n"], ends
        coded = _coded(rows, words)
        for _ in range(settings.depth):
            counted = written_alone(_continuations(coded, levels, len(word_n), settings.least), "continuations")
            if counted.count() > settings.broadcast:
                small = False
                break
            arrays = counted.toArrow()
            keys, n = (arrays[c].to_numpy() for c in ("key", "n"))
            order = np.argsort(keys)
            levels.append(Level(keys[order], n[order]))
    if not small:
        return scored_by_parts(rows, ends, settings)
    retain(levels, word_n, total, distinct, settings)
    found = _scored_in_tasks(coded, vocabulary.where(F.col("n") < settings.least), levels, word_n, total, distinct)
    return found.withColumn("train_tokens", F.lit(total).cast("long"))
