"""Language of texts by a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NONE = "und"


@dataclass(frozen=True)
class Settings:
    """Parameters of the network, of the bounded sample it learns from, and of the spans that texts are read in.

    ``rows``: labelled texts taken of each language, those with the smallest hash. ``spans``: spans learned from each
    of them. ``span``: positions of a text that are read at once; ``margin``: bytes read before and after a span, so that its
    first and last positions know their neighbours.
    """

    hidden: int = 8
    span: int = 240
    margin: int = 8
    rows: int = 300
    spans: int = 4
    steps: int = 150
    batch: int = 64
    rate: float = 0.02
    seed: int = 13


@dataclass(frozen=True)
class Network:
    """``inputs`` (2, 3H, 257): what a byte adds to update, reset and candidate of either direction; byte 256 is outside a
    text. ``turn`` (2, 3H, H): what the state adds. ``out`` (K, 2H) and ``bias`` (K): scores of the languages at a position."""

    inputs: np.ndarray
    turn: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def _start(classes: int, s: Settings) -> Network:
    random, h = np.random.default_rng(s.seed), s.hidden
    return Network(random.normal(0, 0.3, (2, 3 * h, 257)).astype(np.float32),
                   random.normal(0, h ** -0.5, (2, 3 * h, h)).astype(np.float32),
                   random.normal(0, h ** -0.5, (classes, 2 * h)).astype(np.float32), np.zeros(classes, dtype=np.float32))


def _logistic(x: np.ndarray) -> np.ndarray:
    """In place, by the hyperbolic tangent, which numpy computes many at a time."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _states(net: Network, codes: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states (T, 2, H, B) of codes (T, B): of either direction after the byte at a position.

    The backward direction reads the same codes from the end. With ``keep``, also what backpropagation needs.
    """
    t, b = codes.shape
    h = net.turn.shape[2]
    both = np.stack((codes, codes[::-1]), axis=1)
    # rows of one long table: the two directions and all three gates of a byte lie together
    table = np.ascontiguousarray(net.inputs.transpose(0, 2, 1)).reshape(2 * 257, 3 * h)
    states, state, kept = np.empty((t, 2, h, b), dtype=np.float32), np.zeros((2, h, b), dtype=np.float32), []
    offset = np.array([[0], [257]])
    for at in range(t):
        given = table[both[at] + offset].transpose(0, 2, 1)
        turned = net.turn @ state
        gates = _logistic(given[:, :2 * h] + turned[:, :2 * h])
        update, reset = gates[:, :h], gates[:, h:]
        new = np.tanh(given[:, 2 * h:] + reset * turned[:, 2 * h:])
        last, state = state, new + update * (state - new)
        states[at] = state
        if keep:
            kept.append((last, update, reset, new, turned[:, 2 * h:]))
    states[:, 1] = states[::-1, 1].copy()
    return states, kept


def _label(net: Network, states: np.ndarray) -> np.ndarray:
    """Probabilities (T, K, B) of the languages at every position."""
    t, _, h, b = states.shape
    score = net.out @ states.reshape(t, 2 * h, b) + net.bias[:, None]
    score -= score.max(axis=1, keepdims=True)
    np.exp(score, out=score)
    score /= score.sum(axis=1, keepdims=True)
    return score


def _gradients(net: Network, codes: np.ndarray, y: np.ndarray) -> tuple[Network, float]:
    """Gradients of the mean cross entropy over all positions inside the texts, by backpropagation through time."""
    states, kept = _states(net, codes, True)
    t, _, h, b = states.shape
    inside = (codes != 256).astype(np.float32)
    p = _label(net, states)
    chosen = np.take_along_axis(p, np.broadcast_to(y, (t, 1, b)), axis=1)[:, 0]
    loss = float(-(np.log(np.maximum(chosen, 1e-9)) * inside).sum() / inside.sum())
    error = p
    np.put_along_axis(error, np.broadcast_to(y, (t, 1, b)), (chosen - 1)[:, None], axis=1)
    error *= (inside / inside.sum())[:, None]
    flat = states.reshape(t, 2 * h, b)
    out, bias = np.einsum("tkb,thb->kh", error, flat, optimize=True), error.sum(axis=(0, 2))
    into = (net.out.T @ error).reshape(t, 2, h, b)
    into[:, 1] = into[::-1, 1].copy()
    both = np.stack((codes, codes[::-1]), axis=1)
    inputs, turn, back = np.zeros((2, 257, 3 * h), dtype=np.float32), np.zeros_like(net.turn), np.zeros((2, h, b), dtype=np.float32)
    for at in range(t - 1, -1, -1):
        last, update, reset, new, turned = kept[at]
        state = into[at] + back
        d_new = state * (1 - update) * (1 - new * new)
        d_update = state * (last - new) * update * (1 - update)
        d_reset = d_new * turned * reset * (1 - reset)
        given = np.concatenate((d_update, d_reset, d_new), axis=1)
        through = np.concatenate((d_update, d_reset, d_new * reset), axis=1)
        turn += through @ last.transpose(0, 2, 1)
        back = state * update + net.turn.transpose(0, 2, 1) @ through
        for side in (0, 1):
            np.add.at(inputs[side], both[at, side], given[side].T)
    return Network(inputs.transpose(0, 2, 1), turn, out, bias), loss


def train(codes: np.ndarray, y: np.ndarray, classes: int, s: Settings) -> Network:
    """A network from spans (codes (N, T), languages (N)): Adam on batches that hold every language alike."""
    net, random = _start(classes, s), np.random.default_rng(s.seed + 1)
    names = ("inputs", "turn", "out", "bias")
    slow, fast = ({n: np.zeros_like(getattr(net, n)) for n in names} for _ in range(2))
    of = [np.flatnonzero(y == k) for k in range(classes)]
    each = max(1, s.batch // classes)
    for step in range(1, s.steps + 1):
        some = np.concatenate([random.choice(rows, each) for rows in of])
        found, _ = _gradients(net, codes[some].T, y[some])
        size = np.sqrt(sum(float((getattr(found, n) ** 2).sum()) for n in names))
        rate, new = s.rate * min(1.0, 2 * (1 - step / (s.steps + 1))), {}
        for n in names:
            g = getattr(found, n) / max(1.0, size)
            slow[n] = 0.9 * slow[n] + 0.1 * g
            fast[n] = 0.99 * fast[n] + 0.01 * g * g
            new[n] = (getattr(net, n) - rate * (slow[n] / (1 - 0.9 ** step)) / (np.sqrt(fast[n] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        net = Network(**new)
    return net


def _windows(flat: np.ndarray, begin: np.ndarray, low: np.ndarray, high: np.ndarray, s: Settings) -> np.ndarray:
    """Codes (N, margin + span + margin) of spans that begin at ``begin`` of the bytes, 256 outside their text [low, high)."""
    at = begin[:, None] + np.arange(-s.margin, s.span + s.margin)
    found = flat[np.clip(at, 0, max(0, len(flat) - 1))].astype(np.int64)
    found[(at < low[:, None]) | (at >= high[:, None])] = 256
    return found


def pooled(net: Network, flat: np.ndarray, offsets: np.ndarray, s: Settings, block: int = 512) -> np.ndarray:
    """Mean probabilities (N, K) over all positions of N texts, which lie one after the other in ``flat``; zeros for empty texts.

    A text is cut into spans from its first byte to its last. Spans of many texts are read side by side, a block at a time, so
    memory depends on the block and not on the texts.
    """
    sizes = np.diff(offsets)
    count = -(-sizes // s.span)
    text = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[text] + nth * s.span
    total = np.zeros((len(sizes), len(net.bias)))
    for low in range(0, len(text), block):
        some = slice(low, low + block)
        codes = _windows(flat, begin[some], offsets[text[some]], offsets[text[some] + 1], s).T
        used = min(len(codes), s.margin + int(np.minimum(sizes[text[some]], s.span).max()) + s.margin)
        states, _ = _states(net, np.ascontiguousarray(codes[:used]), False)
        inner = slice(s.margin, s.margin + s.span)
        p = _label(net, states[inner])
        p *= (codes[:used][inner] != 256)[:, None]
        np.add.at(total, text[some], p.sum(axis=0, dtype=np.float64).T)
    return total / np.maximum(sizes, 1)[:, None]


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))


def learned(docs: DataFrame, teaches: Column, text: str = "text", lang: str = "lang", s: Settings = Settings()) -> tuple[list[str], Network | None]:
    """The languages in order of their names, and a network for them; None if nothing teaches.

    Of every language the ``rows`` texts with the smallest hash that have a letter and are labelled, and of each of
    these up to ``spans`` spans spread over it: both bounds are parameters, so what comes to the driver does not grow with the input.
    """
    rows = docs.where(teaches & F.col(lang).isNotNull() & has_letter(F.col(text))).select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("body"))
    first = Window.partitionBy("lang").orderBy("spot")
    # a text may be very long: only its spans come along
    width = F.lit(s.span)
    step = F.greatest(F.floor((F.octet_length("body") - width) / F.lit(max(1, s.spans - 1))), width)
    count = F.least(F.lit(s.spans), F.greatest(F.ceil(F.octet_length("body") / width), F.lit(1)))
    parts = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.substring(F.col("body"), (i * step + 1).cast("int"), width))
    sample = rows.select("lang", F.xxhash64("body").alias("spot"), parts.alias("parts")).withColumn(
        "place", F.row_number().over(first)).where(F.col("place") <= s.rows).select("lang", "spot", "parts").collect()
    names = sorted({r["lang"] for r in sample})
    if not names:
        return [], None
    spans = sorted((r["lang"], r["spot"], i, bytes(p)) for r in sample for i, p in enumerate(r["parts"]) if p)
    offsets = np.cumsum([0] + [len(p) for *_, p in spans])
    codes = _windows(np.frombuffer(b"".join(p for *_, p in spans), dtype=np.uint8), offsets[:-1], offsets[:-1], offsets[1:], s)
    y = np.array([names.index(lang) for lang, *_ in spans])
    return names, train(codes, y, len(names), s)


def identified(docs: DataFrame, teaches: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
               settings: Settings = Settings()) -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (mean probability of that language over all positions) of every text.

    The network learns from a bounded sample of the rows where ``teaches`` holds and the language is known; a prediction
    reads the whole text and nothing else. A text that is null or has no letter is ``und`` with score 0, and so are all texts
    if nothing teaches. Ties go to the first language by name. Texts of any length are read in spans. Repeated rows get equal
    results; extra columns are ignored; an empty table gives an empty result.
    """
    s = settings
    names, net = learned(docs, teaches, text, lang, s)
    rows = docs.select(F.col(key).alias("key"), F.when(has_letter(F.col(text)), F.col(text)).alias("text"))
    if net is None:
        return rows.select("key", F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # few rows at a time: a batch may hold thousands of long texts
            for low in range(0, whole.num_rows, 2000):
                batch = whole.slice(low, 2000)
                body = batch.column(1).cast(pa.large_binary())
                texts = [v for v in body.to_pylist() if v is not None]
                given = np.array(body.is_valid())
                p = pooled(net, np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0] + [len(v) for v in texts]), s)
                best, lang_pred, score = p.argmax(axis=1), np.full(len(given), NONE, dtype=object), np.zeros(len(given))
                lang_pred[given] = np.array(names, dtype=object)[best]
                score[given] = np.round(p[np.arange(len(p)), best], 6)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang_pred, pa.string()), pa.array(score)],
                                                 names=["key", "lang_pred", "score"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(predicted, f"key {kind}, lang_pred string, score double")
