"""The probabilistic suffix tree where words or tree are too large for a task: the same model and scores, looked up by parts.

Neither words nor tree are ever in one place. Texts are coded once, in parts of bounded size with the words of each part numbered
from 0. For the words, and then for each context length, a part asks the buckets of the model once for each distinct entry that
it holds, and a bucket adds up what all parts have and answers each part in the order asked. Requests and answers are packed arrays.
The contexts are tested by joins in which only counted continuations take part.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerflow.workdir import remove, written_alone, written_by_kind

if TYPE_CHECKING:
    from offerflow.llm.lm import Settings

#: Ids of a word that is too rare for the tree, of the end token, and of the first other word.
RARE, END, FIRST = 0, 1, 2
#: Buckets of the words; the most buckets of a level, and tokens for each up to there.
WORD_BUCKETS, MOST_BUCKETS, BUCKET_TOKENS = 1024, 2048, 1 << 21
#: Tokens of a row of coded texts, and rows that a task takes out of a batch at once.
ROW_TOKENS, ROWS_AT_ONCE = 1 << 18, 256
#: ``level`` of a part's rows: answers have the level's number, what contexts leave that and ``LEFT``, then come buckets of words, texts.
LEFT, BUCKETS_OF_WORDS, TEXTS = 100, 1000, 1001

_ZSTD = pa.Codec("zstd", 1)
_ROWS = "part long, level int, bucket int, data binary"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}

Rows = list[tuple[object, ...]]
#: Rows of a kind, and their folder.
Written = dict[str, tuple[DataFrame, str]]


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays in few bytes: the narrowest type for integers (none below 0), equal places of all numbers together, compressed."""
    made = []
    for x in arrays:
        if x.dtype.kind != "f":
            x = x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)
        planes = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
        made.append((x.dtype.str, len(x), _ZSTD.compress(planes, asbytes=True) if planes else b""))
    return pickle.dumps(made)


def unpacked(data: bytes) -> list[np.ndarray]:
    """What ``packed`` was given, as 64-bit integers and floats."""
    found = []
    for kind, n, planes in pickle.loads(data):
        x = np.dtype(kind)
        raw = np.frombuffer(_ZSTD.decompress(planes, n * x.itemsize), dtype=np.uint8) if n else np.empty(0, dtype=np.uint8)
        x = np.ascontiguousarray(raw.reshape(x.itemsize, n).T).view(x).reshape(n)
        found.append(x if x.dtype.kind == "f" else x.astype(np.int64))
    return found


def ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (none below 0) in order, and the place of each key among them.

    As ``np.unique``; keys that leave room for their places are sorted together with these, which takes a fraction of its time.
    """
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()) >> (62 - bits):
        return np.unique(keys, return_inverse=True)
    both = keys << bits
    both |= np.arange(len(keys))
    both.sort()
    places = (both & ((1 << bits) - 1)).astype(np.int32)
    both >>= bits
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(both[1:], both[:-1], out=new[1:])
    ranks = np.empty(len(keys), dtype=np.int32)
    ranks[places] = np.cumsum(new, dtype=np.int32) - 1
    return both[new], ranks


def _by_bucket(bucket: np.ndarray) -> np.ndarray:
    return np.argsort(bucket.astype(np.uint16), kind="stable")  # a radix sort


class _Numbered(dict[bytes, int]):
    """Numbers words by their first occurrence."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _fields(schema: str) -> dict[str, pa.DataType]:
    return {name: _KINDS[kind] for name, kind in (x.split() for x in schema.split(", "))}


def _batch(schema: str, rows: Rows) -> pa.RecordBatch:
    fields = _fields(schema)
    columns = zip(*rows, strict=True) if rows else ([],) * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, fields.values(), strict=True)], list(fields))


def _coded(rows: DataFrame, settings: Settings) -> Written:
    """``texts`` with the words of a part numbered from 0, and what each part asks the buckets of the words (``asked``).

    A part is some texts of a task, its id is made here and kept by writing. The end token has the number after the last word.
    """
    schema = f"{_ROWS}, tokens long, kind string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        words, keys, held, ids, size = _Numbered(), [], [], [], 0

        def closed() -> Iterator[pa.RecordBatch]:
            tokens, out, n_tokens = np.concatenate(ids), np.array(held), np.array([len(i) for i in ids])
            n = np.bincount(tokens[np.repeat(~out, n_tokens)], minlength=len(words))
            bucket = np.fromiter((zlib.crc32(w) % WORD_BUCKETS for w in words), dtype=np.int64, count=len(words))
            yield _batch(schema, [(part, BUCKETS_OF_WORDS, 0, packed(bucket), 0, "texts")])
            null = np.array([k is None for k in keys])
            known = np.array([k or 0 for k in keys], dtype=np.int64).view(np.uint64)
            ends = np.cumsum(n_tokens + 1)
            low = 0
            while low < len(keys):
                before = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, before + ROW_TOKENS)))
                some = slice(low, high)
                data = packed(n_tokens[some], out[some], null[some], known[some], tokens[before - low:ends[high - 1] - high])
                yield _batch(schema, [(part, TEXTS, low, data, int(ends[high - 1] - before), "texts")])
                low = high
            order, listed = _by_bucket(bucket), list(words)
            starts = np.searchsorted(bucket[order], np.arange(WORD_BUCKETS + 1))
            asked = []
            for b in np.flatnonzero(np.diff(starts)):
                at = order[starts[b]:starts[b + 1]]
                joined = np.frombuffer(b" ".join([listed[i] for i in at]), dtype=np.uint8)
                asked.append((part, 0, int(b), packed(joined, n[at]), 0, "asked"))
            yield _batch(schema, asked)

        for batch in batches:
            for key, out, text in zip(batch["key"], batch["held_out"], batch["text"], strict=True):
                tokens = tokens_of(text.as_py())
                keys.append(key.as_py())
                held.append(out.as_py())
                ids.append(np.fromiter(map(words.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
                size += len(tokens) + 1
                if size >= settings.part:
                    yield from closed()
                    part += 1
                    words, keys, held, ids, size = _Numbered(), [], [], [], 0
        if keys:
            yield from closed()

    return written_by_kind(rows.select("key", "held_out", "text").mapInArrow(run, schema), "coded-texts", ["texts", "asked"])


def _runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple[int, Rows]]:
    """Rows of sorted batches that follow each other and have the same value in ``by``."""
    value, held = None, []
    for batch in batches:
        place = batch.schema.get_field_index(by)
        for low in range(0, batch.num_rows, ROWS_AT_ONCE):
            for row in zip(*(c.to_pylist() for c in batch.slice(low, ROWS_AT_ONCE).columns), strict=True):
                if held and row[place] != value:
                    yield value, held
                    held = []
                value = row[place]
                held.append(row)
    if held:
        yield value, held


def _answered(asked: DataFrame, answer: Callable[[int, list[int], list[list[np.ndarray]]], Rows]) -> Written:
    """``answer`` of the bucket, the parts and the requests (``data``) of a bucket at a time, written.

    Kinds: ``answers``; ``listed``, the contexts whose test a part waits for; ``counted``, the counted entries of a bucket;
    ``sums``, of words the occurrences and number in a bucket.
    """
    schema = f"{_ROWS}, kind string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _runs(batches, "bucket"):
            yield _batch(schema, answer(bucket, [r[0] for r in rows], [unpacked(r[2]) for r in rows]))

    dealt = asked.select("part", "bucket", "data").repartition("bucket").sortWithinPartitions("bucket", "part")
    return written_by_kind(dealt.mapInArrow(run, schema), "answers", ["answers", "listed", "counted", "sums"])


def _counted(rows: DataFrame, names: list[str]) -> DataFrame:
    """The counted entries of all buckets, a row each, of longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["data"]:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, unpacked(data.as_py()))), names)

    return rows.select("data").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _words(asked: DataFrame, settings: Settings) -> Written:
    """Answers for the words: occurrences, and place among the frequent words of the bucket from 1 on (0: rare). Counted: ``id``, ``n``."""
    def answer(bucket: int, parts: list[int], asked: list[list[np.ndarray]]) -> Rows:
        lists = [words.astype(np.uint8).tobytes().split(b" ") for words, _ in asked]
        n: dict[bytes, int] = {}
        for words, (_, counts) in zip(lists, asked, strict=True):
            for word, count in zip(words, counts.tolist(), strict=True):
                n[word] = n.get(word, 0) + count
        frequent = sorted((w for w, x in n.items() if x >= settings.least), key=lambda w: (-n[w], w))
        place = {w: i + 1 for i, w in enumerate(frequent)}
        ids = FIRST + np.arange(len(frequent)) * WORD_BUCKETS + bucket
        sums = packed(np.array([sum(n.values()), sum(x > 0 for x in n.values())]))
        return [(None, 0, bucket, packed(ids, np.array([n[w] for w in frequent], dtype=np.int64)), "counted"), (None, 0, bucket, sums, "sums"),
                *((part, 0, bucket, packed(np.array([n[w] for w in words]), np.array([place.get(w, 0) for w in words])), "answers")
                  for part, words in zip(parts, lists, strict=True))]

    return _answered(asked, answer)


@dataclass
class Items:
    """What a part holds of one level: words, or counted continuations. ``p``: probability of the last word after the others."""

    id: np.ndarray
    n: np.ndarray
    p: np.ndarray


@dataclass
class Asked:
    """Distinct continuations that a part holds at a level: ``context`` and ``shorter`` continuation (places among the items of the level before).

    ``tokens`` have the continuations ``of_token``. ``bucket`` and ``order`` of each continuation, bucket and context of all entries
    asked, sorted. Contexts that occur ``spread`` times or more (``hot``) have an entry wherever a continuation of theirs is, others one in all.
    """

    tokens: np.ndarray
    of_token: np.ndarray
    context: np.ndarray
    shorter: np.ndarray
    bucket: np.ndarray
    order: np.ndarray
    entry_bucket: np.ndarray
    entry_context: np.ndarray
    hot: np.ndarray


def _asked(context: np.ndarray, place: np.ndarray, items: Items, buckets: int, settings: Settings) -> Asked:
    """``context``, ``place``: of each token, items of the level before that end before it and with it (-1: none)."""
    size, inside = len(items.id), context >= 0
    tokens = np.flatnonzero(inside & (place >= 0))  # a longer context with this token cannot be frequent where the shorter is not
    keys, of_token = ranks(context[tokens].astype(np.int64) * size + place[tokens])
    before, shorter = keys // max(1, size), keys % max(1, size)
    hot = items.n >= settings.spread
    bucket = items.id[before] % buckets
    dealt = hot[before]
    bucket[dealt] = (items.id[before[dealt]] * 31 + items.id[shorter[dealt]]) % buckets
    present = np.flatnonzero(np.bincount(context[inside], minlength=size))
    once = present[~hot[present]]
    entries = np.unique(np.concatenate((bucket * size + before, items.id[once] % buckets * size + once)))
    return Asked(tokens, of_token, before, shorter, bucket, _by_bucket(bucket), entries // max(1, size), entries % max(1, size), hot)


def _requests(part: int, asked: Asked, train: np.ndarray, items: Items, buckets: int) -> Rows:
    n = np.bincount(asked.of_token, weights=train[asked.tokens], minlength=len(asked.context)).astype(np.int64)
    order, size = asked.order, len(items.id)
    continued, lengths = np.unique((asked.bucket * size + asked.context)[order], return_counts=True)
    runs = np.zeros(len(asked.entry_context), dtype=np.int64)
    runs[np.searchsorted(asked.entry_bucket * size + asked.entry_context, continued)] = lengths
    ends = np.searchsorted(asked.entry_bucket, np.arange(buckets + 1)), np.searchsorted(asked.bucket[order], np.arange(buckets + 1))
    made = []
    for b in np.flatnonzero(np.diff(ends[0])):
        entries, at = slice(ends[0][b], ends[0][b + 1]), order[ends[1][b]:ends[1][b + 1]]
        made.append((part, int(b), packed(items.id[asked.entry_context[entries]], runs[entries], items.id[asked.shorter[at]], n[at])))
    return made


def _continued(asked: DataFrame, level: int, buckets: int, settings: Settings) -> Written:
    """Answers for a level: of each continuation its place among the counted ones of the bucket from 1 on (0: rare) and its occurrences.

    Counted: ``id``, ids ``c`` and ``s`` of context and shorter continuation, ``n``.
    """
    def answer(bucket: int, parts: list[int], asked: list[list[np.ndarray]]) -> Rows:
        ids, runs, shorter, counts = (np.concatenate(x) for x in zip(*asked, strict=True))
        contexts, of_entry = ranks(ids)
        shorters, of_shorter = ranks(shorter)
        keys, of_key = ranks(np.repeat(of_entry, runs).astype(np.int64) * max(1, len(shorters)) + of_shorter)
        n = np.bincount(of_key, weights=counts, minlength=len(keys)).astype(np.int64)
        counted = np.flatnonzero(n >= settings.least)
        place = np.zeros(len(keys), dtype=np.int64)
        place[counted] = 1 + np.arange(len(counted))
        made, low = [(None, level, bucket, packed(
            np.arange(len(counted)) * buckets + bucket, contexts[keys[counted] // max(1, len(shorters))], shorters[keys[counted] % max(1, len(shorters))],
            n[counted]), "counted")], 0
        for part, (of, some, *_) in zip(parts, asked, strict=True):
            mine = of_key[low:(low := low + some.sum())]
            made += [(part, level, bucket, packed(place[mine], np.where(place[mine] > 0, n[mine], 0)), "answers"),
                     (part, level, bucket, packed(of), "listed")]
        return made

    return _answered(asked, answer)


def _tested(counted: DataFrame, before: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The divergence test. ``before``: ``id``, ``n``, ``p`` of the level before. The same of this level, and its states: ``c``, ``seen``,
    occurrences before other words (``rest``), counted continuations (``edges``), what it leaves to its suffix (``back``).

    A context becomes a state if on the training tokens that follow it, its own distribution has a log
    likelihood above that of its longest kept suffix by ``cutoff`` per counted continuation.
    """
    edges = counted.join(before.select(F.col("id").alias("s"), F.col("p").alias("p_before")), "s").join(
        before.select(F.col("id").alias("c"), F.col("n").alias("seen")), "c")
    edges = written_alone(edges.select("id", "c", "n", "p_before", "seen", ((F.col("n") - settings.discount) / F.col("seen")).alias("share")), "edges")
    sums = edges.groupBy("c").agg(F.first("seen").alias("seen"), (F.first("seen") - F.sum("n")).alias("rest"), F.count("*").alias("edges"))
    sums = sums.withColumn("back", (F.col("rest") + settings.discount * F.col("edges")) / F.col("seen"))
    own = edges.join(sums.select("c", "back"), "c").withColumn("own", F.col("share") + F.col("back") * F.col("p_before"))
    gains = own.groupBy("c").agg(F.sum(F.col("n") * F.log(F.col("own") / F.col("p_before"))).alias("gain"))
    gain = F.col("gain") + F.when(F.col("rest") > 0, F.col("rest") * F.log("back")).otherwise(0.0)
    states = written_alone(sums.join(gains, "c").where(gain >= settings.cutoff * F.col("edges")).select("c", "seen", "rest", "edges", "back"), "states")
    p = F.coalesce(F.col("share") + F.col("back") * F.col("p_before"), F.col("p_before"))
    return written_alone(edges.join(states.select("c", "back"), "c", "left").select("id", "n", p.alias("p")), "level"), states


def _left(listed: DataFrame, states: DataFrame, level: int, buckets: int) -> DataFrame:
    """Answers for listed contexts: ``edges`` (0: no state) and ``rest``, which say what the context leaves to its suffix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _runs(batches, "bucket"):
            known = sorted(r[3:] for r in rows if r[0] is None)
            ids, edges, rest = np.array([*known, (-1, 0, 0)], dtype=np.int64).T
            made = []
            for part, _, data, *_ in rows[len(known):]:
                (of,) = unpacked(data)
                at = np.searchsorted(ids[:-1], of)
                at[ids[at] != of] = len(ids) - 1
                made.append((part, level + LEFT, bucket, packed(edges[at], rest[at])))
            yield _batch(_ROWS, made)

    none = F.lit(None).cast("long")
    lists = listed.select("part", "bucket", "data", none.alias("c"), none.alias("edges"), none.alias("rest"))
    known = states.select(none, F.expr(f"cast(c % {buckets} as int)"), F.lit(None).cast("binary"), "c", "edges", "rest")
    dealt = lists.union(known).repartition("bucket").sortWithinPartitions("bucket", F.col("part").asc_nulls_first())
    return written_alone(dealt.mapInArrow(run, _ROWS), "left")


def _part(part: int, rows: Rows, level: int, spread: list[tuple[np.ndarray, np.ndarray]], ends: int, size: float, buckets: int,
          settings: Settings) -> Rows | list[np.ndarray]:
    """What a part asks at ``level``, or beyond the last level its scores, from all answers so far.

    ``spread``: of each level, ids of the spread contexts that are states, and what they leave to their suffix.
    """
    def answers(k: int) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*(unpacked(r[3]) for r in rows if r[1] == k), strict=True)]

    lengths, held, null, keys, inside_texts = (np.concatenate(x) for x in zip(*(unpacked(r[3]) for r in rows if r[1] == TEXTS), strict=True))
    (bucket,) = next(unpacked(r[3]) for r in rows if r[1] == BUCKETS_OF_WORDS)
    last = np.cumsum(lengths + 1) - 1
    tokens = np.full(last[-1] + 1, len(bucket), dtype=np.int32)
    inner = np.ones(len(tokens), dtype=bool)
    inner[last] = False
    tokens[inner] = inside_texts
    del inside_texts
    order = _by_bucket(bucket)
    n, ids = np.full(len(bucket) + 1, ends), np.full(len(bucket) + 1, END)
    if len(bucket):
        often, place = answers(0)
        n[order], ids[order] = often, np.where(place > 0, FIRST + (place - 1) * WORD_BUCKETS + bucket[order], RARE)
    words = items = Items(ids, n, (n + 1.0) / size)
    place = np.where(ids[tokens] == RARE, np.int32(-1), tokens)
    prob = items.p[tokens] if level > settings.depth else None
    for k in range(1, settings.depth + 1):
        context = np.concatenate((np.full(1, -1, dtype=np.int32), place[:-1]))
        context[1:][~inner[:-1]] = -1  # the end token is no context, so none crosses a text
        asked = _asked(context, place, items, buckets, settings)
        if k == level:
            return _requests(part, asked, np.repeat(held == 0, lengths + 1), items, buckets)
        in_order, often, edges, rest = [*answers(k), *answers(k + LEFT)] or np.empty((4, 0), dtype=np.int64)
        back = np.ones(len(items.id))
        of_state = np.flatnonzero((edges > 0) & ~asked.hot[asked.entry_context])
        state = asked.entry_context[of_state]
        back[state] = (rest[of_state] + settings.discount * edges[of_state]) / items.n[state]
        hot, (states, leave) = np.flatnonzero(asked.hot), spread[k - 1]
        if len(hot) and len(states):
            at = np.minimum(np.searchsorted(states, items.id[hot]), len(states) - 1)
            back[hot] = np.where(states[at] == items.id[hot], leave[at], 1.0)
        of_key, n = np.empty_like(in_order), np.empty_like(often)
        of_key[asked.order], n[asked.order] = in_order, often
        counted = np.flatnonzero(of_key > 0)
        before, shorter = asked.context[counted], asked.shorter[counted]
        share = np.where(back[before] < 1.0, (n[counted] - settings.discount) / items.n[before], 0.0)
        number = np.full(len(of_key), -1, dtype=np.int32)
        number[counted] = np.arange(len(counted))
        place = np.full(len(place), -1, dtype=np.int32)
        place[asked.tokens] = number[asked.of_token]
        items = Items((of_key[counted] - 1) * buckets + asked.bucket[counted], n[counted], share + back[before] * items.p[shorter])
        if prob is not None:
            inside, counted = context >= 0, place >= 0
            prob[inside] *= back[context[inside]]
            prob[counted] += share[place[counted]]
    if prob is None:
        return []
    first = last - lengths
    score = np.add.reduceat(np.log10(prob, out=prob), first)
    base = np.add.reduceat(np.log10(words.n + 1.0)[tokens], first) - (lengths + 1) * np.log10(size)
    return [keys, null > 0, held > 0, lengths + 1, np.add.reduceat((words.n > 0).astype(np.int64)[tokens], first), base, score]


def scored_by_parts(rows: DataFrame, ends: int, settings: Settings) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``base_score``, ``score``, ``train_tokens`` of ``rows`` (``key``, ``held_out``,
    ``text``). ``ends``: number of texts that are not held out.

    Only distinct words and continuations of a part move to the buckets and back, and the coded texts once a level; what a
    step has moved is removed when its result is written. To the driver come only states that occur ``spread`` times or more.
    """
    spark, coded = rows.sparkSession, _coded(rows, settings)
    tokens = coded["texts"][0].agg(F.sum("tokens")).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(4, tokens // BUCKET_TOKENS))
    words = _words(coded["asked"][0], settings)
    remove(spark, coded["asked"][1])
    sums = [unpacked(r["data"])[0] for r in words["sums"][0].select("data").collect()]
    total = int(sum(x[0] for x in sums)) + ends
    size, depth = total + int(sum(x[1] for x in sums)) + (1 if ends else 0) + 1.0, settings.depth
    found, spread = coded["texts"][0].select(*_fields(_ROWS)).union(words["answers"][0]), []

    def by_part(level: int, schema: str, made: Callable[[Rows | list[np.ndarray]], pa.RecordBatch]) -> DataFrame:
        known = list(spread)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, rows in _runs(batches, "part"):
                yield made(_part(part, rows, level, known, ends, size, buckets, settings))

        return found.repartition("part").sortWithinPartitions("part", "level", "bucket").mapInArrow(run, schema)

    ends_row = spark.createDataFrame([(END, ends)], "id long, n long")
    level_before = _counted(words["counted"][0], ["id", "n"]).union(ends_row).select("id", "n", ((F.col("n") + 1.0) / size).alias("p"))
    asked = "part long, bucket int, data binary"
    for level in range(1, depth + 1):
        answers = _continued(by_part(level, asked, lambda x: _batch(asked, x)), level, buckets, settings)
        level_before, states = _tested(_counted(answers["counted"][0], ["id", "c", "s", "n"]), level_before, settings)
        hot = states.where(F.col("seen") >= settings.spread).select("c", "back").toArrow().sort_by("c")
        spread.append((hot["c"].to_numpy(), hot["back"].to_numpy()))
        found = found.union(answers["answers"][0]).union(_left(answers["listed"][0], states, level, buckets))
        for kind in ("counted", "listed"):
            remove(spark, answers[kind][1])
    result = "key long, held_out boolean, n_tokens long, n_known long, base_score double, score double"

    def scored(x: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x[0], pa.int64(), mask=x[1]), *map(pa.array, x[2:])], [c.split()[0] for c in result.split(", ")])

    return by_part(depth + 1, result, scored).withColumn("train_tokens", F.lit(total).cast("long"))
