"""Ranked lexical search: the best documents of every item, by norm buckets.

A document's impact vector has a coordinate for each term of the items: the square root of the
term's weight times the term's impact in the document. An item's vector has the square root of the weight times the
term's repeats, so their product is the score. Vectors are put in order of length, the longest
first, and stored. Stretches of ``bucket`` vectors are buckets.

For an item whose k-th best score so far is t, a bucket is left out when the item's length times
the bucket's greatest length is below t (Cauchy-Schwarz). Inside a bucket the item's ``focus``
largest coordinates are multiplied out; what the others can add is at most the product of the
lengths of the two remainders, and at most their sum at the greatest value that each coordinate has in the
bucket. Vectors whose sum is below t are left out. What survives is scored again exactly in 64-bit integers. Bounds are rounded up, so no equal score is lost to them.

Work on Spark: one pass over the texts makes vectors of counts; document frequencies are counted
over all of them; vectors are sorted by ranges of their length, ties by row, so equal texts do not meet in
one task. The longest vectors are searched first, which gives every item a threshold; the rest is read from
the length on that can still reach one (a filter on the stored column) and searched in parallel, each task
keeping ``k`` rows an item. Items are taken in blocks of about ``block_bytes`` of text, so what is
sent to the tasks has a bound; there is no bound on their number.

Defined results: items and documents without a term (null, empty, punctuation only) rank nothing and are not
ranked. Rows that repeat an item id are one item, the least text counting; items without id
are one item. Every document row is a document of its own, also where ids repeat; documents
without an id come first among equal scores (an id of -2**63 is read as none). Ties are in order of doc_id. Empty
tables give no rows. Texts of any length are split into terms about ``STRETCH`` bytes at a time. Other columns
may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressmark.session import stage

STRETCH = 4 << 20
_NO_ID = np.iinfo(np.int64).min
_TERM = frozenset((*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)))
# letters of A-Z in lower case, terms' other bytes as they are, all else a space
_FOLDED = bytes((b + 32 if 65 <= b <= 90 else b) if b in _TERM else 32 for b in range(256))
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


@dataclass(frozen=True)
class Search:
    """Documents an item, vectors of a bucket and of the first search, coordinates of the bound, bytes of a block of items."""

    k: int = 10
    bucket: int = 128
    first: int = 20_000
    focus: int = 32
    block_bytes: int = 8 << 20


def term_counts(text: bytes | None) -> Counter[bytes]:
    """How often each term is in a text."""
    counts: Counter[bytes] = Counter()
    at, text = 0, text or b""
    while at < len(text):
        cut = _BETWEEN.search(text, at + STRETCH) if len(text) - at > STRETCH else None
        end = cut.start() if cut else len(text)
        counts.update(text[at:end].translate(_FOLDED).split())
        at = end
    return counts


@dataclass(frozen=True)
class Items:
    """A block of items: ids, the number of each term, and each item's sorted terms and their repeats."""

    ids: list
    terms: dict[bytes, int]
    held: list[np.ndarray]
    repeats: list[np.ndarray]


def read_items(rows: list[tuple]) -> Items:
    """Rows are pairs of id and text."""
    counts = [term_counts((text or "").encode()) for _, text in rows]
    terms = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    held = [np.array(sorted(terms[t] for t in own), dtype=np.int64) for own in counts]
    by_number = [{terms[t]: n for t, n in own.items()} for own in counts]
    repeats = [np.array([own[i] for i in kept.tolist()], dtype=np.int64) for own, kept in zip(by_number, held)]
    return Items([i for i, _ in rows], terms, held, repeats)


_COUNTED = "doc_id long, n long, terms array<int>, tf array<int>"


def counted(documents: DataFrame, items: Broadcast) -> DataFrame:
    """doc_id, number of terms, and the items' terms in each document that has a term, with their counts."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value.terms
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                kept, sizes, numbers, found = [], [], [], []
                for i, text in enumerate(part.column("text").cast(pa.large_binary())):
                    counts = term_counts(text.as_py())
                    if not counts:
                        continue
                    own = sorted((known[t], n) for t, n in counts.items() if t in known)
                    kept.append(i)
                    sizes.append(counts.total())
                    numbers.append([t for t, _ in own])
                    found.append([n for _, n in own])
                ids = part.column("doc_id").take(pa.array(kept, pa.int64()))
                lists = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes, pa.int64()), pa.array(numbers, lists), pa.array(found, lists)],
                    names=["doc_id", "n", "terms", "tf"],
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(vectors, _COUNTED)


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all their terms, and the items' terms' weights by number."""

    documents: int
    terms: int
    weights: np.ndarray

    def damping(self, n: np.ndarray) -> np.ndarray:
        return 100 - 75 + (75 * n * self.documents) // self.terms

    def impacts(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def corpus_of(counts: DataFrame, items: Items) -> Corpus:
    total = counts.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n = total["documents"]
    weights = np.zeros(len(items.terms), dtype=np.int64)
    # a row for each term of the block at most
    for row in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        weights[row["t"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * row["df"] + 1)))
    return Corpus(n, total["terms"], weights)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of an array column and where each row's begin."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64), offsets - offsets[0]


def _lengths(corpus: Broadcast, n: Column, terms: Column, tf: Column) -> Column:
    """Lengths of the impact vectors."""

    @F.arrow_udf("double")
    def of(sizes: pa.Array, numbers: pa.Array, counts: pa.Array) -> pa.Array:
        known = corpus.value
        (number, at), (count, _) = _flat(numbers), _flat(counts)
        m = np.repeat(known.damping(sizes.to_numpy(zero_copy_only=False).astype(np.int64)), np.diff(at))
        squares = known.weights[number] * known.impacts(count, m).astype(np.float64) ** 2
        row = np.repeat(np.arange(len(sizes)), np.diff(at))
        return pa.array(np.sqrt(np.bincount(row, weights=squares, minlength=len(sizes))))

    return of(n, terms, tf)


class _Best:
    """The best rows of each item so far, and the score that a row must reach to be one of them."""

    def __init__(self, thresholds: np.ndarray, k: int):
        self.k, self.thresholds = k, thresholds.copy()
        self.scores = [np.zeros(0, dtype=np.int64) for _ in thresholds]
        self.ids = [np.zeros(0, dtype=np.int64) for _ in thresholds]

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        kept = (scores > 0) & (scores >= self.thresholds[item])
        if not kept.any():
            return
        scores, ids = np.concatenate((self.scores[item], scores[kept])), np.concatenate((self.ids[item], ids[kept]))
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[item], self.ids[item] = scores[order], ids[order]
        if len(order) == self.k:
            self.thresholds[item] = max(self.thresholds[item], self.scores[item][-1])

    def rows(self) -> pa.RecordBatch:
        sizes = [len(s) for s in self.scores]
        ids = np.concatenate([*self.ids, np.zeros(0, dtype=np.int64)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)),
                pa.array(ids, mask=ids == _NO_ID),
                pa.array(np.concatenate([*self.scores, np.zeros(0, dtype=np.int64)])),
            ],
            names=["item", "doc_id", "score"],
        )


class Buckets:
    """The search of a block of items in buckets of stored vectors."""

    GROUP = 256  # items whose bounds are worked out together

    def __init__(self, items: Items, corpus: Corpus, search: Search):
        self.items, self.corpus, self.search = items, corpus, search
        self.roots = np.sqrt(corpus.weights.astype(np.float64))
        vectors = [self.roots[held] * n for held, n in zip(items.held, items.repeats)]
        self.lengths = np.array([np.sqrt((v**2).sum()) for v in vectors])
        self.focus, self.focus_values, self.others, self.other_values, rest = [], [], [], [], []
        for held, v in zip(items.held, vectors):
            order = np.argsort(-v, kind="stable")
            top, low = order[: search.focus], order[search.focus :]
            self.focus.append(held[top])
            self.focus_values.append(v[top])
            self.others.append(held[low])
            self.other_values.append(v[low])
            rest.append(max(float((v**2).sum() - (v[top] ** 2).sum()), 0.0))
        self.rest = np.sqrt(rest)

    def scan(self, lengths: np.ndarray, ids: np.ndarray, m: np.ndarray, number: np.ndarray, tf: np.ndarray, at: np.ndarray, best: _Best) -> None:
        """Search vectors in order of their length, the longest first."""
        for begin in range(0, len(lengths), self.search.bucket):
            end = min(begin + self.search.bucket, len(lengths))
            # the threshold of an item against the product of the two lengths
            open_items = np.flatnonzero(self.lengths * lengths[begin:end].max() * (1 + 1e-9) >= np.maximum(best.thresholds, 1))
            if not len(open_items):
                continue
            own = slice(at[begin], at[end])
            row = np.repeat(np.arange(end - begin), np.diff(at[begin : end + 1]))
            impact = self.corpus.impacts(tf[own], m[begin:end][row])
            key = row * len(self.items.terms) + number[own]  # ascending, as terms of a row are
            for group in range(0, len(open_items), self.GROUP):
                chosen = open_items[group : group + self.GROUP]
                survivors = self._bounded(chosen, row, number[own], impact, lengths[begin:end], best.thresholds)
                for place, item in enumerate(chosen.tolist()):
                    rows = np.flatnonzero(survivors[:, place])
                    if len(rows):
                        best.add(item, self._exact(item, rows, key, impact), ids[begin:end][rows])

    def _bounded(self, chosen: np.ndarray, row: np.ndarray, number: np.ndarray, impact: np.ndarray, lengths: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
        """Which vectors may reach which items' thresholds, by their coordinates in focus."""
        shown = np.unique(np.concatenate([self.focus[i] for i in chosen]))
        place = np.minimum(np.searchsorted(shown, number), max(len(shown) - 1, 0))
        hit = shown[place] == number if len(shown) else np.zeros(len(number), dtype=bool)
        table = np.zeros((len(lengths), len(shown)))
        table[row[hit], place[hit]] = impact[hit] * self.roots[number[hit]]
        values, inside = np.zeros((len(chosen), len(shown))), np.zeros((len(chosen), len(shown)))
        for k, i in enumerate(chosen.tolist()):
            at = np.searchsorted(shown, self.focus[i])
            values[k, at], inside[k, at] = self.focus_values[i], 1
        known = table @ values.T
        remains = np.sqrt(np.maximum((lengths**2)[:, None] * (1 + 1e-9) - (table**2) @ inside.T, 0))
        # no coordinate is above its greatest value in the bucket, which is 0 for terms that are not in it
        greatest = np.zeros(len(self.items.terms))
        np.maximum.at(greatest, number, impact * self.roots[number])
        others = np.array([float(self.other_values[i] @ greatest[self.others[i]]) for i in chosen])
        return (known + np.minimum(remains * self.rest[chosen], others)) * (1 + 1e-9) >= np.maximum(thresholds[chosen], 1)

    def _exact(self, item: int, rows: np.ndarray, key: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Scores of some rows of a bucket, in integers."""
        held, repeats = self.items.held[item], self.items.repeats[item]
        wanted = rows[:, None] * len(self.items.terms) + held
        place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        found = np.where(key[place] == wanted, impact[place], 0)
        return (found * (self.corpus.weights[held] * repeats)).sum(axis=1)


def searched(vectors: DataFrame, items: Broadcast, corpus: Broadcast, thresholds: Broadcast, search: Search) -> DataFrame:
    """``k`` rows (item, doc_id, score) an item and task at most; none below the thresholds."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(items.value, corpus.value, search)
        best = _Best(thresholds.value, search.k)
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            m = corpus.value.damping(batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64))
            (number, at), (tf, _) = _flat(batch.column("terms")), _flat(batch.column("tf"))
            buckets.scan(lengths, ids, m, number, tf, at, best)
        yield best.rows()

    wanted = vectors.select("length", "doc_id", "n", "terms", "tf")
    return wanted.mapInArrow(scan, "item int, doc_id long, score long")


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _ranked_block(documents: DataFrame, rows: list[tuple], search: Search) -> DataFrame:
    """item (place in ``rows``), rank, doc_id, score."""
    spark = documents.sparkSession
    share = spark.sparkContext.broadcast
    items = read_items(rows)
    shared = share(items)
    counts = stage(counted(documents, shared).withColumn("row", F.monotonically_increasing_id()), "counts")
    corpus = corpus_of(counts, items)
    known = share(corpus)
    sized = counts.withColumn("length", _lengths(known, F.col("n"), F.col("terms"), F.col("tf"))).where("length > 0")
    vectors = stage(sized.repartitionByRange(F.desc("length"), "row").sortWithinPartitions(F.desc("length"), "row"), "vectors")
    n = vectors.count()
    edge = vectors.agg(F.percentile_approx("length", max(0.0, 1 - search.first / max(n, 1)), 10_000)).first()[0] or 0.0
    nothing = np.zeros(len(rows), dtype=np.int64)
    first = stage(_best_rows(searched(vectors.where(F.col("length") >= edge), shared, known, share(nothing), search), search.k), "first")
    thresholds = nothing.copy()
    for row in first.where(F.col("rank") == search.k).select("item", "score").collect():  # a row an item at most
        thresholds[row["item"]] = row["score"]
    lengths = Buckets(items, corpus, search).lengths
    least = min((t / length for t, length in zip(thresholds, lengths) if length > 0), default=math.inf) * (1 - 1e-9)
    rest = vectors.where((F.col("length") < edge) & (F.col("length") >= least))
    other = searched(rest, shared, known, share(thresholds), search)
    return _best_rows(first.drop("rank").unionByName(other), search.k)


def ranked(documents: DataFrame, items: DataFrame, search: Search = Search()) -> DataFrame:
    """item_id, rank, doc_id and score of the ``search.k`` best documents of every item."""
    spark = documents.sparkSession
    texts = items.groupBy("item_id").agg(F.min("text").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // search.block_bytes)
    placed = stage(texts.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))), "items")
    kind = items.schema["item_id"].dataType.simpleString()
    found = []
    for block in range(blocks):
        rows = [tuple(r) for r in placed.where(F.col("block") == block).select("item_id", "text").collect()]
        if rows:
            named = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], f"item int, item_id {kind}")
            found.append(_ranked_block(documents, rows, search).join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


_ORACLE_TERMS = r"""
regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ORACLE_TERMS} AS terms FROM documents),
docs AS (SELECT r, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, corpus),
q AS (SELECT item_id, term, count(*)::BIGINT AS repeats
      FROM (SELECT item_id, unnest({_ORACLE_TERMS}) AS term FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id))
      GROUP BY ALL),
scored AS (
  SELECT q.item_id, docs.doc_id, docs.r,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN docs USING (r), corpus
  GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 10
"""
