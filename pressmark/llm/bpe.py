"""Byte-level BPE: text to token ids with offsets, and ids back to bytes and text.

The merges come from a rank file (base64 token and rank a line). The tokenizers library
works on characters, so every byte stands for one printable character. A rank file lists
tokens, not merges; every split of a token into two tokens of lower rank is a merge of that
token's rank, so ids are those of an encoder that always joins the adjacent pair of lowest
rank. Each match of the split pattern is encoded on its own, without special tokens.

Words repeat, so a task hands a piece to the library once while it keeps its ids: those of the pieces
met last, twice ``_CACHED`` at most. Texts and Arrow batches are never cut. Decoding reverses the table of
bytes; a text decoder holds back a character whose bytes are split over two blocks of ids.

Defined results: a null text is encoded as an empty one, an empty text has no ids and
decodes to nothing. Null or unknown ids decode to no bytes. Every byte string that is not
UTF-8 decodes to U+FFFD in text form and unchanged in byte form.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer, models

# more than the pieces that repeat; the ids of rare ones only take memory
_CACHED = 100_000


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class ByteBpe:
    """An encoder and decoder for one rank file and one split pattern."""

    def __init__(self, ranks_path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        table = byte_characters()
        spelt = {token: "".join(table[b] for b in token) for token in ranks}
        merges = []
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            for at in range(1, len(token)):
                left, right = token[:at], token[at:]
                if ranks.get(left, rank) < rank and ranks.get(right, rank) < rank:
                    merges.append((spelt[left], spelt[right]))
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.library = Tokenizer(models.BPE({spelt[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.spelling = dict(enumerate(table))
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        texts = iter(texts)
        while block := list(islice(texts, 64)):
            cut = [self.pieces(text) for text in block]
            self._learn(set(chain.from_iterable(cut)))
            for pieces in cut:
                yield list(chain.from_iterable(map(self.known.__getitem__, pieces)))

    def _learn(self, pieces: set[str]) -> None:
        """Have the library encode the pieces not known yet, each as a word of its own.

        Where there are too many, those known become the older ones, and older ones not met since are forgotten.
        """
        if len(self.known) > _CACHED:
            self.known, self.older = {}, self.known
        new = []
        for piece in pieces.difference(self.known):
            if (ids := self.older.get(piece)) is None:
                new.append(piece)
            else:
                self.known[piece] = ids
        spelt = [p.encode().decode("latin-1").translate(self.spelling) for p in new]
        found = self.library.encode(spelt, is_pretokenized=True, add_special_tokens=False)
        ids, words = found.ids, np.array(found.word_ids, dtype=np.int64)
        starts = np.searchsorted(words, np.arange(len(new) + 1)).tolist()
        self.known.update((piece, ids[starts[i] : starts[i + 1]]) for i, piece in enumerate(new))

    def offsets(self, text: str, ids: list[int | None]) -> list[tuple[int, int]]:
        """First and past-last character of every token; tokens within one character share it.

        An id that is null or unknown has no bytes: it begins and ends where the next token begins. What
        ids say beyond the end of the text begins and ends there.
        """
        bounds, done = [], 0
        starts = [0]  # byte at which each character begins
        for character in text:
            starts.append(starts[-1] + len(character.encode()))
        at = 0
        for i in ids:
            begin, done = done, min(done + len(self.tokens.get(i, b"")), starts[-1])
            while at < len(text) and starts[at + 1] <= begin:
                at += 1
            end = at
            while done > begin and starts[end] < done:
                end += 1
            bounds.append((at, end))
        return bounds

    def decode(self, ids: Iterable[int | None]) -> bytes:
        return b"".join([self.tokens.get(i, b"") for i in ids])

    def decode_text(self, blocks: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of consecutive blocks of ids; a character split between blocks comes with the later one."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for block in blocks:
            yield decoder.decode(self.decode(block))
        yield decoder.decode(b"", final=True)


@lru_cache(maxsize=2)
def tokenizer(ranks_path: str, pattern: str) -> ByteBpe:
    """One encoder a worker process."""
    return ByteBpe(ranks_path, pattern)


def encode(text: Column, ranks_path: str, pattern: str) -> Column:
    """Token ids of a text column. ``ranks_path`` names a file present on every executor."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        found = tokenizer(ranks_path, pattern).encode(t or "" for t in _values(texts))
        return pa.array(found, pa.list_(pa.int32()))

    return ids(text)


def decode(ids: Column, ranks_path: str, pattern: str) -> Column:
    """The bytes of a column of ids; null for null."""

    @F.arrow_udf("binary")
    def data(column: pa.Array) -> pa.Array:
        bpe = tokenizer(ranks_path, pattern)
        return pa.array([None if v is None else bpe.decode(v) for v in _values(column)], pa.binary())

    return data(ids)


def with_offsets(text: Column, ids: Column, ranks_path: str, pattern: str) -> Column:
    """First and past-last character of every id of a text."""

    @F.arrow_udf("array<struct<begin: int, end: int>>")
    def bounds(texts: pa.Array, column: pa.Array) -> pa.Array:
        bpe = tokenizer(ranks_path, pattern)
        made = [
            [{"begin": b, "end": e} for b, e in bpe.offsets(t or "", i or [])] for t, i in zip(_values(texts), _values(column))
        ]
        return pa.array(made, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))

    return bounds(text, ids)


def _values(column: pa.Array) -> Iterator:
    """Python values of a column, a few rows at a time."""
    for at in range(0, len(column), 64):
        yield from column.slice(at, 64).to_pylist()


def _digests(batches: Iterator[pa.RecordBatch], ranks_path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    bpe = tokenizer(ranks_path, pattern)
    for batch in batches:
        sizes, ids_hash, data_hash = [], [], []
        for ids in bpe.encode(t or "" for t in _values(batch.column("text"))):
            sizes.append(len(ids))
            ids_hash.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            data_hash.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(data_hash, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def round_trip(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Ids and decoded bytes of every text as counts and digests; one narrow pass, ids stay in the task."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(
        partial(_digests, ranks_path=ranks_path, pattern=pattern),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
