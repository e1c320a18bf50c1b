"""License scans: an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """A text that a block may contain. A phrase's words must also stand next to each other, anywhere in the text."""

    label: str
    text: str
    phrase: bool = False


# The base phrases, and well-known wordings of public licenses.
TEMPLATES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
    Template("mit", "released under the mit license"),
    Template("mit", "licensed under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                    "documentation files the software to deal in the software without restriction"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("apache-2.0", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
                    "following conditions are met"),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                    "license as published by the free software foundation"),
    Template("lgpl", "licensed under the gnu lesser general public license"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("copyright", "copyright c all rights reserved"),
)

#: Words that a window inside one line has at least, so that lines up to that length are blocks as they are.
LINE = 40

_KEPT = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_KEPT_LINES = bytes(10 if c == 10 else k for c, k in enumerate(_KEPT))


def words_of(text: str) -> list[bytes]:
    """Words of the text with A-Z in lower case: runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.encode().translate(_KEPT).split()


def blocks_of(text: str) -> Iterator[list[bytes]]:
    """Words of every line that has some."""
    for line in text.encode().translate(_KEPT_LINES).split(b"\n"):
        words = line.split()
        if words:
            yield words


def vocabulary(templates: tuple[Template, ...]) -> set[bytes]:
    return {w for t in templates for w in words_of(t.text)}


def token_frequencies(docs: DataFrame, templates: tuple[Template, ...], text: str) -> dict[bytes, int]:
    """In how many text blocks of the whole table each template word occurs; as many rows as the templates have words."""
    known = vocabulary(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch["text"]:
                for block in blocks_of(value.as_py() or ""):
                    found.update(known.intersection(block))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                                         ["word", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"].encode(): r["n"] for r in counted.collect()}


class Index:
    """Inverted index over the prefixes of templates, whose words are in order of global frequency, rarest first."""

    def __init__(self, templates: tuple[Template, ...], frequencies: dict[bytes, int], threshold: float) -> None:
        self.rank = {w: i for i, w in enumerate(sorted(vocabulary(templates), key=lambda w: (frequencies.get(w, 0), w)))}
        self.sets = [sorted({self.rank[w] for w in words_of(t.text)}) for t in templates]
        self.least = [len(s) if t.phrase else max(1, math.ceil(threshold * len(s) - 1e-9)) for t, s in zip(templates, self.sets, strict=True)]
        self.whole = [t.phrase for t in templates]
        self.width = [math.ceil(len(words_of(t.text)) / threshold) for t in templates]
        self.words = [set(words_of(t.text)) for t in templates]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, (tokens, least) in enumerate(zip(self.sets, self.least, strict=True)):
            for place, token in enumerate(tokens[:len(tokens) - least + 1]):
                self.prefix.setdefault(token, []).append((t, place))

    def matches(self, block: set[bytes], whole: bool) -> dict[int, int]:
        """Template -> shared words, for each template of which the block holds enough.

        A block that does must hold a word of the template's prefix, and have as many words as must be
        shared. At the first shared word, the words before it in the template are missing, so what is left after
        it, in the template and in the block, bounds the overlap. Survivors are counted exactly.
        """
        rank = self.rank
        held = sorted(rank[w] for w in rank.keys() & block)
        found: dict[int, int] = {}
        tried: set[int] = set()
        for at, token in enumerate(held):
            for t, place in self.prefix.get(token, ()):
                if self.whole[t] != whole or t in tried:
                    continue
                tried.add(t)
                tokens, least = self.sets[t], self.least[t]
                if len(block) < least or 1 + min(len(tokens) - place - 1, len(held) - at - 1) < least:
                    continue
                shared = len(set(tokens).intersection(held))
                if shared >= least:
                    found[t] = shared
        return found


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    first, n, at, found = phrase[0], len(phrase), -1, []
    while True:
        try:
            at = words.index(first, at + 1)
        except ValueError:
            return found
        if words[at:at + n] == phrase:
            found.append(at)


def _windows(hits: list[tuple[int, bytes]], width: int, least: int) -> list[tuple[int, int, int]]:
    """(first, last, shared): windows of at most ``width`` words with ``least`` of a template's words, ``hits`` by place.

    Of windows that overlap the best so far, the one that shares most stays, the first if they share the same.
    """
    found: list[tuple[int, int, int]] = []
    held: Counter[bytes] = Counter()
    low = 0
    for at, word in hits:
        held[word] += 1
        while at - hits[low][0] >= width or held[hits[low][1]] > 1:
            held[hits[low][1]] -= 1
            if not held[hits[low][1]]:
                del held[hits[low][1]]
            low += 1
        if len(held) >= least:
            window = (hits[low][0], at, len(held))
            if not found or window[0] > found[-1][1]:
                found.append(window)
            elif window[2] > found[-1][2]:
                found[-1] = window
    return found


def _blocks(index: Index, t: int, words: list[bytes], line_of: list[int]) -> dict[int, int]:
    """Line -> shared words, for each line that has a template's words in one window or begins a window that has."""
    known, least = index.words[t], index.least[t]
    hits = [(i, w) for i, w in enumerate(words) if w in known]
    found: dict[int, int] = {}
    start = 0
    for end in range(1, len(hits) + 1):
        if end == len(hits) or line_of[hits[end][0]] != line_of[hits[start][0]]:
            if end - start >= least:
                best = max((n for *_, n in _windows(hits[start:end], max(LINE, index.width[t]), least)), default=0)
                if best:
                    found[line_of[hits[start][0]]] = best
            start = end
    for first, last, n in _windows(hits, index.width[t], least):
        lines = range(line_of[first], line_of[last] + 1)
        if len(lines) > 1 and all(found.get(line, 0) < n for line in lines):
            found[lines[0]] = n
    return found


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, threshold: float = 0.9, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Templates found in each document, a row per document.

    ``key``, ``n_words``, ``places`` (starts of phrases with their labels), ``matches`` (block number, label, containment).

    The templates are a fixed list, so their prefix index is small and goes to every task; the blocks stay
    where they are, and nothing of the documents is shuffled. Word frequencies come from all blocks of the
    table. Blocks are windows of words: over the whole text, whatever its line breaks, as wide as the template's words over the
    threshold; and inside a line at least ``LINE`` words wide, so that a usual line is one block. A match has the number of
    the line where its window begins, once a line. The prefix, length and positional filters run on the text, which
    must pass if a window does. For phrases a block is the whole text, and the exact check of the words' order follows. Null and empty texts have no words. Null keys and repeated rows are scanned
    each. Other columns are ignored. An empty table gives an empty result.
    """
    index = Index(templates, token_frequencies(docs, templates, text), threshold)
    phrases = [words_of(t.text) for t in templates]
    place, match = pa.struct([("start", pa.int64()), ("label", pa.string())]), pa.struct(
        [("block", pa.int64()), ("label", pa.string()), ("containment", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, places, matches = [], [], []
            for value in batch["text"]:
                blocks = list(blocks_of(value.as_py() or ""))
                words = [w for block in blocks for w in block]
                distinct = set(words)
                whole = index.matches(distinct, True)
                places.append([{"start": p, "label": templates[t].label} for t in sorted(whole) for p in _places(words, phrases[t])])
                likely = index.matches(distinct, False)
                line_of = [b for b, block in enumerate(blocks) for _ in block] if likely else []
                matches.append([{"block": b, "label": templates[t].label, "containment": shared / len(index.sets[t])}
                                for t in likely for b, shared in sorted(_blocks(index, t, words, line_of).items())])
                n_words.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(n_words, pa.int64()), pa.array(places, pa.list_(place)), pa.array(matches, pa.list_(match))],
                ["key", "n_words", "places", "matches"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(
        run, "key long, n_words long, places array<struct<start:long,label:string>>, "
             "matches array<struct<block:long,label:string,containment:double>>")
