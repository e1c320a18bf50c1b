"""Pack documents into fixed-length token sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerflow.llm.common import ranked, written

#: Words whose ids a worker keeps from one task to the next, and rows it yields at once.
REMEMBERED, ROWS = 1_000_000, 4096
#: A capital before a character from U+0300 on, where the combining marks begin.
MARKED = re.compile(rb"[A-Z][\xCC-\xFF]")


@lru_cache(maxsize=1)
def _ids_of_words(path: str):
    """A function from a list of ASCII-white-space-free words (bytes) to the little-endian bytes of their ids."""
    from tokenizers import Tokenizer

    tokenizer, known = Tokenizer.from_file(path), {}

    def ids(words: list[bytes]) -> bytes:
        new = list({w for w in words if w not in known})
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set(words))
        for low in range(0, len(new), ROWS):
            part = new[low:low + ROWS]
            coded = tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            known.update((w, b"".join(i.to_bytes(4, "little") for i in c.ids)) for w, c in zip(part, coded, strict=True))
        return b"".join([known[w] for w in words])

    return ids


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 4096, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Token pieces of every document: ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``.

    A document's ids are the tokenizer's, then ``end_id``; it is cut every ``length`` ids. The
    vocabulary drops white space and never joins characters across it, so a word's ids do not
    depend on its neighbours and each distinct word of a task is encoded once. ``tokenizer`` is the path of a
    vocabulary file of that kind, present on every executor.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids_of, names = _ids_of_words(tokenizer), ["key", "start", "length", "ids_crc32", "doc_tokens"]
        for batch in batches:
            rows = []
            for key_, text_ in zip(batch["key"].to_pylist(), batch["text"], strict=True):
                data = (text_.as_py() or "").encode()
                # the vocabulary is lower case, so words that differ in case share an entry; but special tokens do not, and
                # since it composes characters first, a capital with marks may be another word than its small letter
                as_is = b"<|" in data or (not data.isascii() and MARKED.search(data))
                ids = ids_of((data if as_is else data.lower()).split()) + end
                total = len(ids) // 4
                for start in range(0, total, length):
                    part = ids[4 * start:4 * (start + length)]
                    rows.append((key_, start, len(part) // 4, zlib.crc32(part), total))
            for low in range(0, len(rows), ROWS):
                columns = zip(*rows[low:low + ROWS], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(
        run, "key long, start long, length long, ids_crc32 long, doc_tokens long")


#: A pattern: runs of (length, times) from the longest length on.
Pattern = tuple[tuple[int, int], ...]


def patterns(histogram: dict[int, int], length: int) -> list[tuple[Pattern, int]]:
    """Shortest-pack-first: packing patterns and how often each is used.

    Lengths are placed longest first, each into the packs that hold least so far; a length that
    does not fit there fits nowhere and opens packs of its own. Packs of like content are counted, not listed: the
    work depends on the number of different lengths, not of documents.
    """
    packs: dict[int, dict[Pattern, int]] = defaultdict(lambda: defaultdict(int))  # tokens held -> pattern -> packs
    heap: list[int] = []

    def add(held: int, pattern: Pattern, count: int) -> None:
        if held not in packs:
            heappush(heap, held)
        packs[held][pattern] += count

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            held = heap[0] if heap else length
            if held + size > length:
                fit = length // size
                full, rest = divmod(left, fit)
                if full:
                    add(fit * size, ((size, fit),), full)
                if rest:
                    add(rest * size, ((size, rest),), 1)
                break
            heappop(heap)
            others = packs.pop(held)
            level = min(heap[0] if heap else length, length)  # the next fuller packs
            for pattern, count in sorted(others.items()):
                if not left:
                    add(held, pattern, count)
                    continue
                used = min(left, count)
                times = max(1, min(-((held - level) // size), (length - held) // size, left // used))
                run = ((size, pattern[-1][1] + times),) if pattern[-1][0] == size else (pattern[-1], (size, times))
                add(held + times * size, (*pattern[:-1], *run), used)
                if used < count:
                    add(held, pattern, count - used)
                left -= used * times
    return [(pattern, count) for held in sorted(packs, reverse=True) for pattern, count in sorted(packs[held].items())]


def slots(found: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, sequences, offset): which ranks of a length go where.

    A run of t pieces in n like packs takes n * t ranks; the rank modulo n names the pack.
    """
    rows, taken, sequence = [], defaultdict(int), 0
    for pattern, count in found:
        offset = 0
        for size, times in pattern:
            rows.append((size, taken[size], taken[size] + times * count, sequence, count, offset))
            taken[size] += times * count
            offset += size * times
        sequence += count
    return rows


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 4096, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Where every token piece goes: the columns of ``pieces``, ``sequence_id`` and ``offset``.

    Only the histogram of lengths, at most ``length`` rows, reaches the driver; the patterns found there go back as
    slots, whose number depends on the different lengths, not on the documents. A piece finds its
    slot by its length and its rank among the pieces of that length. Ranks are distributed, so one
    frequent length is no single task. Null and empty texts give one piece, the end id. Repeated rows are packed
    each. Null keys are kept. An empty table gives an empty result. Other columns are ignored.
    """
    cut = written(pieces(docs, tokenizer, end_id, length, key, text), "token-pieces")  # the ranks read it twice
    order = [F.col("length").asc(), F.col("key").asc_nulls_first(), F.col("start").asc(), F.col("ids_crc32").asc()]
    placed = ranked(cut, order, "place")
    lengths = placed.groupBy("length").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    counted = lengths.collect()  # at most `length` rows
    first = {r["length"]: r["first"] for r in counted}
    rows = [(size, first[size] + low, first[size] + high, *rest) for size, low, high, *rest
            in slots(patterns({r["length"]: r["n"] for r in counted}, length))]
    where = docs.sparkSession.createDataFrame(
        rows, "size long, low long, high long, first_sequence long, sequences long, first_offset long")
    found = placed.join(F.broadcast(where), F.expr("length = size and place >= low and place < high"))
    turn = F.col("place") - F.col("low")
    return found.select("key", "start", "length", "ids_crc32", "doc_tokens",
                        (F.col("first_sequence") + turn % F.col("sequences")).alias("sequence_id"),
                        (F.col("first_offset") + F.floor(turn / F.col("sequences")) * F.col("size")).alias("offset"))
