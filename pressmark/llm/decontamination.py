"""Benchmark decontamination by spaced seeds. DataFrame functions only.

Both sides are lower-cased and split into words at white space. At every position each mask
takes the hash of the words it selects, skipping the others, so a seed still matches where a
skipped word was replaced. Training seeds that occur in the benchmark are hits. A hit fixes
how the two texts lie against each other; the words of the item are compared with those of
the document in that position, and the document is contaminated if some ``window``
consecutive words that hold the seed agree in ``percent`` of a hundred. With the default
masks every window of 13 words with up to two replaced words holds a seed, wherever they are.

The benchmark's seeds go to every task if there are at most ``broadcast_rows`` of them and their
words (18 at most each) have at most ``broadcast_bytes`` (both counted first); texts are then read
once and not shuffled, windows are made and dropped within a task. Beyond that, narrow rows of
document, place and seed are joined with the benchmark's seeds, and only hits meet the words of
their document. A seed that a third of all places share is spread over ``salts`` keys.

Defined results: null and wordless texts are clean. Words of a window that lie outside the
item or the document count as replaced; for items with fewer words than the window,
``percent`` of the item's words must agree. Items shorter than a mask (8 words) are searched for whole, word for
word; those of less than ``shortest`` words are no evidence and are not searched for. Null and repeated items and ids do no harm; equal items are all named.
Rows that share a ``doc_id`` are judged each on its own in ``decontaminated``, together in
``leaks``. An empty benchmark leaves everything clean. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pressmark.session import stage


@dataclass(frozen=True)
class Seeds:
    """Masks of equal span (1: taken), words compared, hundredths that agree, words of the shortest item, most seeds and bytes to broadcast, keys a seed."""

    masks: tuple[str, ...] = ("11101011", "11001111")
    window: int = 13
    percent: int = 80
    shortest: int = 4
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 128 * 2**20
    salts: int = 16

    @property
    def span(self) -> int:
        return len(self.masks[0])


def words(text: Column) -> Column:
    """Lower-cased words of a text."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(F.btrim(lower, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")


def _with_seeds(table: DataFrame, words_column: str, settings: Seeds, short: tuple[int, ...] = ()) -> DataFrame:
    """One row for each position and mask: ``place`` and ``seed``, all columns kept.

    ``short`` are the lengths of items below the span: all words of such a length are a seed as well,
    so the seed of an item is that of the whole item.
    """
    masks = [*settings.masks, *["1" * n for n in short]]
    size = F.size(words_column)
    last = size - min(map(len, masks))
    placed = table.withColumn("place", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))))
    hashes = [
        F.xxhash64(F.lit(i), *[F.get(words_column, F.col("place") + at) for at, taken in enumerate(mask) if taken == "1"])
        for i, mask in enumerate(masks)
    ]
    if short:  # masks of several lengths: none reaches beyond the end
        hashes = [F.when(F.col("place") + len(mask) <= size, h) for mask, h in zip(masks, hashes)]
    return placed.withColumn("seed", F.explode(F.array(*hashes)))


def _short_lengths(items: DataFrame, settings: Seeds) -> tuple[int, ...]:
    """Lengths of items below the span, at most as many as the span has words."""
    size = F.size("words")
    found = items.where(size.between(settings.shortest, settings.span - 1) & (F.get("words", F.lit(0)) != "")).select(size.alias("n"))
    return tuple(sorted(r["n"] for r in found.distinct().collect()))


def _around(settings: Seeds) -> tuple[Column, Column]:
    """The words of all windows that hold the seed at ``place``, and where the seed is among them."""
    start = F.greatest(F.lit(0), F.col("place") - (settings.window - settings.span))
    return F.slice("words", start + 1, F.col("place") - start + settings.window), F.col("place") - start


def _agrees(settings: Seeds) -> Column:
    """Whether a window of words that holds the seed agrees; what lies outside either text does not."""
    reach = settings.window - settings.span
    wanted = settings.percent * F.least(F.lit(settings.window), F.col("item_size"))

    def same(at: Column) -> Column:
        return F.when(F.get("own_words", F.col("own_at") + at) == F.get("item_words", F.col("item_at") + at), 1).otherwise(0)

    def enough(first: Column) -> Column:
        return F.aggregate(F.slice(matches, first, settings.window), F.lit(0), lambda total, x: total + x) * 100 >= wanted

    matches = F.transform(F.sequence(F.lit(-reach), F.lit(settings.window - 1)), same)
    return F.exists(F.sequence(F.lit(1), F.lit(reach + 1)), enough)


def _is_small(seeds: DataFrame, settings: Seeds) -> bool:
    size = seeds.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.array_join("item_words", " "))).alias("size")).first()
    return size["n"] <= settings.broadcast_rows and (size["size"] or 0) <= settings.broadcast_bytes


_HIT = ("doc_id", "item_id", "item_size", "item_at", "item_words", "own_at", "own_words")


def _broadcast_hits(texts: DataFrame, seeds: DataFrame, settings: Seeds, short: tuple[int, ...]) -> DataFrame:
    """Seeds of ``texts`` (doc_id, words) that the benchmark has, with the words around them on both sides."""
    around, at = _around(settings)
    # one generated loop up to the short stretch around a hit: neither positions nor the words of
    # a document beside them are stored. Agreement is worked out in the aggregate that follows,
    # which keeps the loop small enough to be compiled.
    placed = _with_seeds(texts, "words", settings, short)
    return placed.join(F.broadcast(seeds), "seed").select(*_HIT[:5], at.alias("own_at"), around.alias("own_words"))


def _shuffled_hits(texts: DataFrame, seeds: DataFrame, settings: Seeds, short: tuple[int, ...]) -> DataFrame:
    """As :func:`_broadcast_hits`, for any number of seeds. No join carries both places and whole texts."""
    around, at = _around(settings)
    texts = texts.withColumn("copy", F.xxhash64("words"))
    salt = F.pmod(F.xxhash64("doc_id", "copy", "place"), F.lit(settings.salts)).cast("int").alias("salt")
    every = F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1))).alias("salt")
    places = _with_seeds(texts, "words", settings, short).where("seed is not null").select("doc_id", "copy", "place", "seed", salt)
    # repeated rows of one document and text are one from here on
    found = places.join(seeds.select("seed").distinct().select("seed", every), ["seed", "salt"], "left_semi").distinct()
    whole = texts.dropDuplicates(["doc_id", "copy"]).withColumnsRenamed({"doc_id": "text_of", "copy": "text_copy"})
    same = F.col("doc_id").eqNullSafe(F.col("text_of")) & (F.col("copy") == F.col("text_copy"))
    own = found.join(whole, same).select("doc_id", "seed", "salt", at.alias("own_at"), around.alias("own_words"))
    return own.join(seeds.select("*", every), ["seed", "salt"]).select(*_HIT)


def leaks(documents: DataFrame, benchmark: DataFrame, settings: Seeds = Seeds()) -> DataFrame:
    """Rows (doc_id, item_id) for every document that holds a passage of an item."""
    around, at = _around(settings)
    items = benchmark.where("item_id is not null").select("item_id", words(F.col("text")).alias("words")).distinct()
    short = _short_lengths(items, settings)
    seeds = _with_seeds(items, "words", settings)
    for n in short:
        whole = items.where(F.size("words") == n).withColumn("place", F.lit(0))
        seed = F.xxhash64(F.lit(len(settings.masks) + short.index(n)), *[F.get("words", F.lit(i)) for i in range(n)])
        seeds = seeds.unionByName(whole.withColumn("seed", seed))
    seeds = seeds.select("seed", "item_id", F.size("words").alias("item_size"), at.alias("item_at"), around.alias("item_words"))
    seeds = stage(seeds, "seeds")
    texts = documents.select("doc_id", words(F.col("text")).alias("words"))
    hits = (_broadcast_hits if _is_small(seeds, settings) else _shuffled_hits)(texts, seeds, settings, short)
    return hits.groupBy("doc_id", "item_id").agg(F.max(_agrees(settings)).alias("agrees")).where("agrees").drop("agrees")


def judged(documents: DataFrame, benchmark: DataFrame, settings: Seeds = Seeds()) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, items (ids in order, joined by commas)."""
    found = leaks(documents, benchmark, settings).groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("items")
    )
    rows = documents.select("doc_id").join(found.withColumnRenamed("doc_id", "leaked"), F.col("doc_id").eqNullSafe(F.col("leaked")), "left")
    return rows.select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"),
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, settings: Seeds = Seeds()) -> DataFrame:
    """The rows of ``documents`` that hold no passage of an item, with all their columns."""
    # stored, so that Spark's size check knows the ids and sends them to the texts, which then stay where they are
    found = stage(leaks(documents, benchmark, settings).select("doc_id").distinct(), "leaks")
    dirty = found.withColumnRenamed("doc_id", "leaked_doc_id")
    return documents.join(dirty, documents["doc_id"].eqNullSafe(dirty["leaked_doc_id"]), "left_anti")
