"""Language by cross-parsing entropy.

For every language a suffix automaton holds a bounded stretch of its labelled text. A text is
parsed into the longest phrases that occur in that stretch; a byte that does not occur
is a phrase of its own. A phrase is a place in a stretch of n bytes, so it costs log2(n + 1): the language in
which the letters of the text cost least wins. Letters and their marks are lower-cased, everything else separates words as one space.

Whole texts are parsed, one step of many places and languages at a time. A text is entered at every ``WINDOW``
bytes; each of these parses is then carried on into the next windows up to the first place where
its phrase begins together with one of theirs. From there on the two are the same, so joining
them there gives the phrases of the text parsed in one go, long matches included.

Bounds: at most ``Parse.total`` bytes are learnt over all languages, of labelled texts cut between words; states and
the table sent to every task follow from that. More than ``Parse.languages`` languages are an error.

Defined results: null and letterless texts are ``und`` with score 0, so is everything when
nothing was learnt. Ties in cost go to the language first in byte order. With one language the score
is 1. Equal texts have equal results. Only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressmark.llm.samples import fold
from pressmark.llm.words import row_chunks

WINDOW = 512
# bytes of the marks kept of a run of texts, for as many languages at a time
_MARKS = 32 * 2**20
UNKNOWN = "und"
# letters' bytes stand for themselves in lower case, all others for a space
_SYMBOL = np.full(256, 32, dtype=np.uint8)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(97, 123)
_SYMBOL[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Parse:
    """Bytes learnt of a language, of all languages, texts they come from, most languages."""

    each: int = 24_000
    total: int = 960_000
    texts: int = 48
    languages: int = 256


class Automaton:
    """A suffix automaton of one byte string, as a table of states by symbols; state 0 is the start."""

    def __init__(self, text: bytes, symbols: np.ndarray):
        """``symbols`` maps bytes to columns from 1; column 0 is never passable."""
        width = int(symbols.max()) + 1
        steps: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for symbol in symbols[np.frombuffer(text, np.uint8)].tolist():
            new, at = len(steps), last
            steps.append({})
            length.append(length[last] + 1)
            link.append(0)
            while at >= 0 and symbol not in steps[at]:
                steps[at][symbol] = new
                at = link[at]
            if at >= 0:
                target = steps[at][symbol]
                if length[at] + 1 == length[target]:
                    link[new] = target
                else:
                    copy = len(steps)
                    steps.append(dict(steps[target]))
                    length.append(length[at] + 1)
                    link.append(link[target])
                    while at >= 0 and steps[at].get(symbol) == target:
                        steps[at][symbol] = copy
                        at = link[at]
                    link[target] = link[new] = copy
            last = new
        self.table = np.zeros((len(steps), width), dtype=np.int32)
        for state, ways in enumerate(steps):
            self.table[state, list(ways)] = list(ways.values())


@dataclass(frozen=True)
class LanguageModel:
    """Names in byte order, the column of each byte, all automata in one table with their first states, cost of a phrase."""

    names: list[str]
    symbols: np.ndarray
    table: np.ndarray
    first: np.ndarray
    bits: np.ndarray


def letters(text: Column) -> Column:
    """Letters and their marks in lower case, anything between them as one space; null for a text without letters."""
    return F.when(text.rlike(r"\p{L}"), F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))


def squeezed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case with single spaces between words, per text."""
    symbol = _SYMBOL[data]
    starts = np.zeros(len(data) + 1, dtype=bool)
    starts[offsets] = True
    before = np.concatenate(([32], symbol[:-1])).astype(np.uint8)
    keep = (symbol != 32) | ((before != 32) & ~starts[:-1])
    kept = np.concatenate(([0], np.cumsum(keep)))
    return symbol[keep], kept[offsets]


def learn(texts: dict[str, bytes]) -> LanguageModel:
    """Automata of one stretch of text per language."""
    names = sorted(texts, key=lambda n: n.encode())
    clean = {n: squeezed(np.frombuffer(texts[n], np.uint8), np.array([0, len(texts[n])]))[0].tobytes() for n in names}
    used = np.unique(np.frombuffer(b"".join(clean.values()), np.uint8))
    symbols = np.zeros(256, dtype=np.int16)
    symbols[used] = np.arange(1, len(used) + 1)
    parts, first, total = [], [], 0
    for name in names:
        table = Automaton(clean[name], symbols).table
        table = np.pad(table, ((0, 0), (0, len(used) + 1 - table.shape[1])))
        # 0 stays "no way on"; all others move to the states of this language
        parts.append(np.where(table > 0, table + total, 0).astype(np.int32))
        first.append(total)
        total += len(table)
    table = np.concatenate(parts) if parts else np.zeros((0, 1), np.int32)
    bits = np.log2(1.0 + np.array([len(clean[n]) for n in names]))
    return LanguageModel(names, symbols, table, np.array(first, dtype=np.int64), bits)


def phrases(data: np.ndarray, offsets: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Letters and spaces parsed of each text, and its phrases by language."""
    clean, bounds = squeezed(data, offsets)
    lengths = np.diff(bounds)
    columns, languages = model.symbols[clean], len(model.names)
    out = np.zeros((len(lengths), languages), dtype=np.int64)
    some = max(1, _MARKS // (2 * max(1, len(columns))))
    for low in range(0, languages, some):
        out[:, low : low + some] = _parsed(columns, bounds, model.table, model.first[low : low + some]).T
    return lengths, out


def _parsed(columns: np.ndarray, bounds: np.ndarray, table: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Phrases of every text (columns of the result) by the automata that start at ``first`` (its rows)."""
    flat, width = table.reshape(-1), table.shape[1]
    lengths = np.diff(bounds)
    windows = -(-lengths // WINDOW)
    row = np.repeat(np.arange(len(lengths)), windows)
    first_lane = np.cumsum(windows) - windows
    place = np.arange(len(row)) - first_lane[row]
    begin, text_end = bounds[:-1][row] + place * WINDOW, bounds[1:][row]
    size = np.minimum(text_end - begin, WINDOW)

    def onward(state, symbol, start):
        """The next state, and whether a phrase begins with this byte."""
        there = flat[state * width + symbol]
        begins = (there == 0) | (state == start)
        there = np.where(there == 0, flat[start * width + symbol], there)
        return np.where(there == 0, start, there), begins

    # all windows from their own beginning. A mark is twice the phrases of the window before a place, plus 1 where one begins
    order = np.argsort(-size, kind="stable")
    entry = begin[order]
    start = np.repeat(first[:, None], len(row), axis=1)
    state, count = start.copy(), np.zeros(start.shape, dtype=np.int64)
    marks = np.zeros((len(first), len(columns)), dtype=np.uint16)
    open_lanes = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), side="left")  # windows longer than step i
    for step, n in enumerate(open_lanes):
        at = entry[:n] + step
        state[:, :n], begins = onward(state[:, :n], columns[at], start[:, :n])
        marks[:, at] = 2 * count[:, :n] + begins
        count[:, :n] += begins
    own, reached = np.empty_like(count), np.empty_like(state)
    own[:, order], reached[:, order] = count, state

    # carried on from the end of each window to where a phrase begins in both parses
    tail = np.zeros(own.shape, dtype=np.int64)
    meets = np.full(own.shape, -1, dtype=np.int64)
    language, lane = np.nonzero(np.broadcast_to(begin + size < text_end, own.shape))
    at, state = (begin + size)[lane], reached[language, lane]
    while len(lane):
        state, begins = onward(state, columns[at], first[language])
        met = begins & (marks[language, at] & 1 == 1)
        meets[language[met], lane[met]] = at[met]
        tail[language, lane] += begins & ~met
        going = ~met & (at + 1 < text_end[lane])
        language, lane, at, state = language[going], lane[going], at[going] + 1, state[going]

    # a window's tail ends in the tail of the window in which it meets that one's parse
    met = meets >= 0
    target = np.where(met, first_lane[row] + (meets - bounds[:-1][row]) // WINDOW, 0)
    by_place = np.argsort(-place, kind="stable")
    cuts = np.searchsorted(-place[by_place], -np.arange(place.max(initial=-1) + 1)[::-1], side="right")
    for low, high in zip(np.concatenate(([0], cuts[:-1])), cuts):
        lanes = by_place[low:high]
        language, k = np.nonzero(met[:, lanes])
        lane = lanes[k]
        into = target[language, lane]
        before = marks[language, meets[language, lane]] >> 1
        tail[language, lane] += own[language, into] - before + tail[language, into]
    out = np.zeros((len(first), len(lengths)), dtype=np.int64)
    filled = np.flatnonzero(windows)
    out[:, filled] = (own + tail)[:, first_lane[filled]]
    return out


def train(documents: DataFrame, settings: Parse = Parse()) -> LanguageModel:
    """Learn from bounded stretches of labelled text: parts of the texts first by a hash, for each language."""
    labelled = documents.select(F.col("text"), F.col("lang")).where("lang is not null").where(F.col("text").rlike(r"\p{L}"))
    distinct = labelled.groupBy("lang", F.xxhash64("text").alias("hash")).agg(F.count("*").alias("copies"))
    languages = [r["lang"] for r in distinct.select("lang").distinct().limit(settings.languages + 1).collect()]
    if len(languages) > settings.languages:
        raise ValueError(f"more than {settings.languages} languages")
    if not languages:
        return learn({})
    each = min(settings.each, settings.total // len(languages))
    first = Window.partitionBy("lang").orderBy("hash")
    # at most ``texts`` rows a language, reduced in every task before the window
    chosen = distinct.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= settings.texts).select("lang", "hash")
    hashed = labelled.withColumn("hash", F.xxhash64("text"))
    stretches = hashed.join(F.broadcast(chosen), ["lang", "hash"]).groupBy("lang", "hash").agg(
        F.first("text").alias("text")
    )
    found: dict[str, list[str]] = {}
    stretches = stretches.select("lang", "hash", F.left(letters(F.col("text")), F.lit(each)).alias("text"))
    for r in sorted(stretches.collect(), key=lambda r: (r["lang"], r["hash"])):  # languages x texts x each at most
        found.setdefault(r["lang"], []).append(r["text"])
    return learn({lang: _stretch([t.encode() for t in texts], each) for lang, texts in found.items()})


def _stretch(texts: list[bytes], size: int) -> bytes:
    """Equal shares of the texts, cut between words; what short ones leave goes to longer ones."""
    out, left = [], size
    for i, text in enumerate(sorted(texts, key=len)):
        out.append(_cut(text, left // (len(texts) - i)))
        left -= len(out[-1])
    return b"\n".join(out)


def _cut(text: bytes, size: int) -> bytes:
    """The first whole words of at most ``size`` bytes, or characters where that is no word."""
    if len(text) <= size or text[size : size + 1] == b" ":
        return text[:size]
    whole = text[:size].decode(errors="ignore").encode()
    return whole[: whole.rindex(b" ")] if b" " in whole else whole


def predict(text: Column, model: Broadcast) -> Column:
    """A struct column ``lang_pred``, ``score``: the best language and the second best's share of the cost of both."""

    @F.arrow_udf("lang_pred string, score double")
    def of(texts: pa.Array) -> pa.Array:
        known, names, scores = model.value, [], []
        for _, data, offsets in row_chunks(texts):
            lengths, counts = phrases(data, offsets, known)
            for length, row in zip(lengths, counts * known.bits):
                if not length or not known.names:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                order = np.argsort(row, kind="stable")
                second = float(row[order[1]]) if len(order) > 1 else 0.0
                names.append(known.names[order[0]])
                scores.append(second / (second + float(row[order[0]])) if len(order) > 1 else 1.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return of(letters(text))


def identified(documents: DataFrame, settings: Parse = Parse()) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Documents whose crc32 of the id is 0 modulo 5 are not learnt from.
    """
    held_out = fold("doc_id", 5) == 0
    model = documents.sparkSession.sparkContext.broadcast(train(documents.where(~held_out), settings))
    rows = documents.select("doc_id", predict(F.col("text"), model).alias("p"))
    return rows.select("doc_id", held_out.alias("held_out"), "p.lang_pred", "p.score")
