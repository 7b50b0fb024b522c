"""Alignment of two tokenizers' tokens over the same bytes, by lockstep merging.

A text is encoded by tokenizer A (byte-level, tokenizers library) and B (pieces, sentencepiece).
Where a token of A and one of B end at the same byte, the text is cut; the tokens between two
cuts form a group, and every token of A in a group is linked with every token of B in it.

All texts of a block are walked at once. One NumPy state vector holds a place in A and a place
in B for every lane, a lane being a text or a stretch of one between certain cuts. Each step
compares the two ends of every lane, advances the side that is behind (both where they meet),
emits the cuts reached and their rectangles of links, and drops lanes that are done. A space
between two other characters is always a cut, as no token of either side reaches over it, so a
long text becomes many short lanes and the number of steps is bounded by ``LANE`` and the longest
stretch without a space. For the same reason equal words are encoded once while they are kept.

Corpus-wide counts of linked id pairs are DataFrame work: pairs of a text are distinct with their
multiplicity; frequent pairs, under a million by their definition, go to every executor and
only rarer ones are shuffled by pair, so a pair that is in every text is no hot key.

Defined results: a null or empty text, and one whose tokens of A or B do not spell a space and the
text, has no tokens: counts of 0 and empty groups. Rows that repeat a ``doc_id`` stay rows of their
own. Equal texts have equal results. Long texts are read in stretches of about ``STRETCH``
characters; a stretch ends at a certain cut, so results do not depend on it. An empty table
gives no rows. Only ``doc_id`` and ``text`` are read, other columns may have any name.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from pressmark.llm.bpe import byte_characters
from pressmark.session import stage

STRETCH = 1 << 20
BLOCK = 1 << 20
LANE = 512
_KEPT_WORDS = 300_000
_KEPT_TOKENS = 3_000_000
# words handed to the libraries at once, as their results are large
_ENCODED = 2000
# links of a larger group are counted by distinct ids instead of being written out
_SMALL_GROUP = 4096
# pairs in more texts than a millionth of all links are sent to every executor: fewer than a million
_FREQUENT_PAIRS = 1_000_000

_CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Tokenizers:
    """Files of A (tokenizers, byte-level) and B (sentencepiece), present on every executor."""

    a_path: str
    b_path: str

    def b_size(self) -> int:
        """A pair of ids is one number: the id of A times this, plus the id of B."""
        return encoders(self).b_size


@lru_cache(maxsize=2)
def encoders(files: Tokenizers) -> "Encoders":
    """One pair of encoders a process."""
    return Encoders(files)


class Encoders:
    """Both encoders, and the ids of the words met last.

    A word is what stands between two certain cuts; it is encoded with the space before it. Words have
    numbers; ``a_at`` and ``b_at`` say where their ids begin in ``a_ids`` and ``b_ids``.
    """

    def __init__(self, files: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(files.a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.b_path)
        self.b_size = self.b.get_piece_size()
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        spelt = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(byte_of[c] for c in token) if set(token) <= byte_of.keys() else token.encode() for token in spelt]
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b_size)]
        self.a_length = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        self.a_texts = [np.array([b"%d%s" % (i, end) for i in range(len(spelt))], dtype=object) for end in (b",", b"|")]
        self.b_texts = [np.array([b"%d%s" % (i, end) for i in range(self.b_size)], dtype=object) for end in (b",", b";")]
        self.forget()

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def forget(self, but: set[str] = frozenset()) -> None:
        """Drop all words but some."""
        kept = [(w, self.words[w]) for w in but if w in self.words] if but else []
        place = np.fromiter((i for _, i in kept), dtype=np.int64, count=len(kept))
        self.words = {w: i for i, (w, _) in enumerate(kept)}
        if not kept:
            self.a_ids = self.b_ids = np.zeros(0, dtype=np.int64)
            self.a_at = self.b_at = np.zeros(1, dtype=np.int64)
            self.exact = np.zeros(0, dtype=bool)
            return
        self.a_ids, self.a_at = _taken(self.a_ids, self.a_at, place)
        self.b_ids, self.b_at = _taken(self.b_ids, self.b_at, place)
        self.exact = self.exact[place]

    def full(self) -> bool:
        return len(self.words) > _KEPT_WORDS or len(self.a_ids) + len(self.b_ids) > _KEPT_TOKENS

    def learn(self, words: set[str]) -> None:
        """Encode the words not known yet."""
        unknown = [w for w in words if w not in self.words]
        if not unknown:
            return
        parts = [self._encoded(unknown[i : i + _ENCODED]) for i in range(0, len(unknown), _ENCODED)]
        a, a_count, b, b_count, exact = map(np.concatenate, zip(*parts))
        self.words.update(zip(unknown, range(len(self.words), len(self.words) + len(unknown))))
        self.a_ids, self.a_at = np.concatenate((self.a_ids, a)), np.concatenate((self.a_at, self.a_at[-1] + np.cumsum(a_count)))
        self.b_ids, self.b_at = np.concatenate((self.b_ids, b)), np.concatenate((self.b_at, self.b_at[-1] + np.cumsum(b_count)))
        self.exact = np.concatenate((self.exact, exact))

    def _encoded(self, new: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of A and how many for each word, the same of B, and which words both spell."""
        data = [b" " + w.encode() for w in new]
        found = ([e.ids for e in self.a.encode_batch_fast([" " + w for w in new], add_special_tokens=False)],
                 self.b.encode(new, num_threads=1))
        parts, exact = [], np.ones(len(new), dtype=bool)
        for ids, token_bytes in zip(found, (self.a_bytes, self.b_bytes)):
            counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(new))
            flat = list(chain.from_iterable(ids))
            exact &= _spelt(data, flat, np.cumsum(counts), token_bytes)
            parts += [np.array(flat, dtype=np.int64), counts]
        return *parts, exact


def _taken(ids: np.ndarray, at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` at some places, and where they begin."""
    counts = np.diff(at)[place]
    return ids[_ranges(at[place], counts)], np.concatenate(([0], np.cumsum(counts)))


def _spelt(words: list[bytes], ids: list[int], ends: np.ndarray, token_bytes: list[bytes]) -> np.ndarray:
    """Which words are the joined bytes of their tokens; ``ends`` counts the tokens up to each word's last."""
    tokens = list(map(token_bytes.__getitem__, ids))
    bytes_before = np.concatenate(([0], np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)))))
    made = np.diff(bytes_before[np.concatenate(([0], ends))])
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    exact = made == size
    said = np.frombuffer(b"".join(tokens), dtype=np.uint8)[np.repeat(exact, made)]
    given = np.frombuffer(b"".join(words), dtype=np.uint8)[np.repeat(exact, size)]
    exact[np.repeat(np.flatnonzero(exact), size[exact])[said != given]] = False
    return exact


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts``, one range after another."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)


@dataclass(frozen=True)
class Groups:
    """Tokens of a block of texts and their groups, in order. ``text`` is a group's place in the block.

    Group g holds the tokens ``a[a_first[g]]`` and on, ``a_count[g]`` of them, and the like of B.
    """

    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray
    a_count: np.ndarray
    b_first: np.ndarray
    b_count: np.ndarray
    text: np.ndarray


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups of all lanes: first tokens and counts on both sides, in order.

    Lane i holds the tokens from ``a_at[i]`` to ``a_at[i + 1]`` and from ``b_at[i]`` to ``b_at[i + 1]``,
    whose last ones end at the same byte.
    """
    a, b, stop = a_at[:-1].copy(), b_at[:-1].copy(), a_at[1:]
    begun = a < stop
    a, b, stop = a[begun], b[begun], stop[begun]
    first_a, first_b = a.copy(), b.copy()
    cuts: list[tuple[np.ndarray, ...]] = []
    while len(a):
        end_a, end_b = a_ends[a], b_ends[b]
        a_moves, b_moves = end_a <= end_b, end_b <= end_a
        a += a_moves
        b += b_moves
        met = a_moves & b_moves
        if met.any():
            # a cut, and the rectangle of links that it closes
            cuts.append((first_a[met], a[met] - first_a[met], first_b[met], b[met] - first_b[met]))
            first_a[met], first_b[met] = a[met], b[met]
            live = a < stop
            if not live.all():
                a, b, stop, first_a, first_b = a[live], b[live], stop[live], first_a[live], first_b[live]
    if not cuts:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    joined = [np.concatenate(x) for x in zip(*cuts)]
    order = np.argsort(joined[0], kind="stable")
    return tuple(x[order] for x in joined)


def align(texts: list[str], coder: Encoders) -> tuple[Groups, np.ndarray]:
    """Groups of a block of texts, and for each text whether both sides spell a space and the text."""
    cut = [_CUT.split(text) for text in texts]
    met = set(chain.from_iterable(cut))
    if coder.full():
        coder.forget(but=met)
    coder.learn(met)
    words = np.fromiter(map(coder.words.__getitem__, chain.from_iterable(cut)), dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), [len(own) for own in cut])
    del cut
    spelt = np.ones(len(texts), dtype=bool)
    spelt[text[~coder.exact[words]]] = False
    words, text = words[spelt[text]], text[spelt[text]]
    a_count, b_count = np.diff(coder.a_at)[words], np.diff(coder.b_at)[words]
    a, b = coder.a_ids[_ranges(coder.a_at[words], a_count)], coder.b_ids[_ranges(coder.b_at[words], b_count)]
    # a lane is a run of words of one text that begins where the tokens before it pass a multiple of LANE
    a_stop, b_stop = np.cumsum(a_count), np.cumsum(b_count)
    lane = (a_stop + b_stop - a_count - b_count) // LANE
    opens = np.ones(len(words), dtype=bool)
    opens[1:] = (lane[1:] != lane[:-1]) | (text[1:] != text[:-1])
    a_at = np.append((a_stop - a_count)[opens], len(a))
    b_at = np.append((b_stop - b_count)[opens], len(b))
    # both sides spell the same bytes, so ends may be counted through the whole block
    found = lockstep(np.cumsum(coder.a_length[a]), np.cumsum(coder.b_length[b]), a_at, b_at)
    return Groups(a, b, *found, np.repeat(text, a_count)[found[0]]), spelt


def link_pairs(groups: Groups, b_size: int, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked id pairs of each text: text, pair and how often it is linked, in order of both."""
    size = groups.a_count * groups.b_count
    small = size <= _SMALL_GROUP
    n = size[small]
    which = np.repeat(np.flatnonzero(small), n)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    a = groups.a[groups.a_first[which] + place // groups.b_count[which]]
    b = groups.b[groups.b_first[which] + place % groups.b_count[which]]
    span = np.int64(len(groups.a) and int(groups.a.max()) + 1) * b_size
    keys, times = np.unique(groups.text[which] * span + a * b_size + b, return_counts=True)
    if not small.all():
        parts_k, parts_t = [keys], [times]
        for g in np.flatnonzero(~small):
            own_a, n_a = np.unique(groups.a[groups.a_first[g] :][: groups.a_count[g]], return_counts=True)
            own_b, n_b = np.unique(groups.b[groups.b_first[g] :][: groups.b_count[g]], return_counts=True)
            parts_k.append((groups.text[g] * span + own_a[:, None] * b_size + own_b).ravel())
            parts_t.append((n_a[:, None] * n_b).ravel())
        keys, times = _summed(np.concatenate(parts_k), np.concatenate(parts_t))
    return keys // max(span, 1), keys % max(span, 1), times


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def group_texts(groups: Groups, coder: Encoders, texts: int) -> list[bytes]:
    """``a1,a2|b1;`` and so on for each text: decimal ids, every group ended by a semicolon."""
    last_a, last_b = np.zeros(len(groups.a), dtype=bool), np.zeros(len(groups.b), dtype=bool)
    last_a[groups.a_first + groups.a_count - 1] = True
    last_b[groups.b_first + groups.b_count - 1] = True
    laid = np.empty(len(groups.a) + len(groups.b), dtype=object)
    place_a = np.arange(len(groups.a)) + np.repeat(groups.b_first, groups.a_count)
    place_b = np.arange(len(groups.b)) + np.repeat(groups.a_first + groups.a_count, groups.b_count)
    for place, ids, last, written in ((place_a, groups.a, last_a, coder.a_texts), (place_b, groups.b, last_b, coder.b_texts)):
        laid[place[~last]] = written[0][ids[~last]]
        laid[place[last]] = written[1][ids[last]]
    ends = np.cumsum(_per_text(groups, groups.a_count + groups.b_count, texts))
    return [b"".join(laid[s:e].tolist()) for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _per_text(groups: Groups, values: np.ndarray, texts: int) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values)))
    bounds = np.searchsorted(groups.text, np.arange(texts + 1))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _stretches(column: pa.Array) -> Iterator[tuple[int, str]]:
    """Row number and text of all stretches, in order; a stretch goes on after the space that ends the one before."""
    for begin in range(0, len(column), 64):
        for i, text in enumerate(column.slice(begin, 64).to_pylist(), begin):
            at = 0
            while text and len(text) - at > STRETCH and (cut := _CUT.search(text, at + STRETCH)):
                yield i, text[at : cut.start()]
                at = cut.end()
            if text:
                yield i, text[at:]


def _blocks(column: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    rows: list[int] = []
    texts: list[str] = []
    size = 0
    for row, text in _stretches(column):
        if texts and size + len(text) > BLOCK:
            yield rows, texts
            rows, texts, size = [], [], 0
        rows.append(row)
        texts.append(text)
        size += len(text)
    if texts:
        yield rows, texts


class _Row:
    """What is known of one text while its stretches pass."""

    def __init__(self) -> None:
        self.spelt, self.counts, self.digest = True, np.zeros(4, dtype=np.int64), None
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, spelt: bool, counts: np.ndarray, written: bytes, pairs: np.ndarray, times: np.ndarray) -> None:
        self.spelt &= spelt
        if not self.spelt:
            self.pairs, self.times, self.digest = [], [], None
            return
        self.counts = self.counts + counts
        if self.digest is None:
            self.digest = hashlib.sha256()
        else:
            self.digest.update(b";")
        self.digest.update(written[:-1])
        self.pairs.append(pairs)
        self.times.append(times)

    def result(self) -> tuple:
        if not self.spelt or self.digest is None:
            return np.zeros(4, dtype=np.int64), "", [], []
        pairs, times = self.pairs[0], self.times[0]
        if len(self.pairs) > 1:
            pairs, times = _summed(np.concatenate(self.pairs), np.concatenate(self.times))
        return self.counts, self.digest.hexdigest(), pairs, times


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def _aligned(batches: Iterator[pa.RecordBatch], files: Tokenizers) -> Iterator[pa.RecordBatch]:
    coder = encoders(files)
    for batch in batches:
        ids = batch.column("doc_id")
        done, row, number = [], _Row(), 0
        for rows, texts in _blocks(batch.column("text")):
            groups, spelt = align(texts, coder)
            n = len(texts)
            counts = np.stack([
                _per_text(groups, v, n)
                for v in (groups.a_count, groups.b_count, np.ones_like(groups.a_count), groups.a_count * groups.b_count)
            ], axis=1)
            text, pairs, times = link_pairs(groups, coder.b_size, n)
            bounds = np.searchsorted(text, np.arange(n + 1))
            for i, written in enumerate(group_texts(groups, coder, n)):
                while number < rows[i]:
                    done.append(row.result())
                    row, number = _Row(), number + 1
                own = slice(bounds[i], bounds[i + 1])
                row.add(bool(spelt[i]), counts[i], written, pairs[own], times[own])
            if len(done) >= 500:
                yield _batch(ids.slice(number - len(done), len(done)), done)
                done = []
        while number < len(ids):
            done.append(row.result())
            row, number = _Row(), number + 1
        yield _batch(ids.slice(len(ids) - len(done), len(done)), done)


def _batch(ids: pa.Array, done: list[tuple]) -> pa.RecordBatch:
    counts = np.array([d[0] for d in done], dtype=np.int64).reshape(len(done), 4)

    def lists(at: int) -> pa.Array:
        offsets = np.concatenate(([0], np.cumsum([len(d[at]) for d in done]))).astype(np.int32)
        values = np.concatenate([np.asarray(d[at], dtype=np.int64) for d in done] or [np.zeros(0, dtype=np.int64)])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    columns = [ids, *[pa.array(counts[:, i]) for i in range(4)], pa.array([d[1] for d in done], pa.string()), lists(2), lists(3)]
    return pa.RecordBatch.from_arrays(
        columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    )


def alignments(documents: DataFrame, files: Tokenizers) -> DataFrame:
    """One row per document, by one narrow pass: counts, the digest of its groups, its distinct linked
    pairs of ids (id of A times ``files.b_size()``, plus id of B) and how often each is linked."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(partial(_aligned, files=files), _ALIGNED)


def token_groups(documents: DataFrame, files: Tokenizers) -> DataFrame:
    """The groups themselves: doc_id, and per document an array of (a: ids of A, b: ids of B, end: byte offset)."""
    schema = "doc_id long, groups array<struct<a: array<int>, b: array<int>, end: long>>"

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoders(files)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("end", pa.int64())]))
        for batch in batches:
            for at, text in enumerate(batch.column("text").to_pylist()):
                own: list[dict] = []
                if text:
                    groups, _ = align([text], coder)
                    ends = np.cumsum(coder.a_length[groups.a])
                    for a, n, b, m in zip(groups.a_first, groups.a_count, groups.b_first, groups.b_count):
                        own.append({"a": groups.a[a : a + n], "b": groups.b[b : b + m], "end": int(ends[a + n - 1])})
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, 1), pa.array([own], kind)], names=["doc_id", "groups"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(written, schema)


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """``pair``, the number of documents that hold it linked, and whether no pair of its id of A has more."""
    counts = stage(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "pairs")
    first = F.floor(F.col("pair") / b_size).alias("a")
    most = counts.groupBy(first).agg(F.max("docs").alias("most"))  # at most a row for each id of A
    marked = counts.withColumn("a", first).join(F.broadcast(most), "a")
    return stage(marked.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "counts")


def linked(documents: DataFrame, files: Tokenizers) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``count_sum`` adds the counts of the pairs of all links; ``n_best`` counts the links whose pair has
    the highest count of its id of A.
    """
    rows = stage(alignments(documents, files).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(rows, files.b_size())
    bound = (counts.agg(F.sum("docs")).first()[0] or 0) / _FREQUENT_PAIRS
    links = rows.select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    known = links.join(F.broadcast(counts.where(F.col("docs") > bound)), "pair", "left")
    rare = known.where(F.col("docs").isNull()).drop("docs", "best").join(counts.where(F.col("docs") <= bound), "pair")
    weighed = known.where(F.col("docs").isNotNull()).unionByName(rare)
    sums = weighed.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
    )
    shown = rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left")
    filled = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return shown.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *filled, "groups_sha256")
