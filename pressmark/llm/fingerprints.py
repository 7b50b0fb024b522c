"""Document fingerprints by one-permutation MinHash.

The shingles of a text (five words, see ``words``) are hashed once. The hash names a bin and
a value; every bin keeps its least value. Empty bins borrow the value of a non-empty bin
found by a sequence of hashes that only bin and attempt decide (optimal densification), so
two texts borrow alike. Of every bin some low bits are kept and packed; the share of equal
bins, less what agrees by chance, estimates the Jaccard similarity of the shingle sets.

Defined results: null, empty and wordless texts have the empty fingerprint; two of those are
alike (1), one of them and any other text are not (0). Equal texts have equal fingerprints,
whatever their row. Texts of any length are hashed whole; memory follows the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressmark.llm.words import SHINGLE, mix, shingle_sets


@dataclass(frozen=True)
class Bins:
    """Number of bins, bits kept of each, words of a shingle."""

    count: int = 256
    bits: int = 8
    shingle: int = SHINGLE


def fingerprint(shingles: np.ndarray, bins: Bins) -> bytes:
    """Packed low bits of the densified bins of one set of shingle hashes."""
    if not len(shingles):
        return b""
    place = (shingles % np.uint64(bins.count)).astype(np.int64)
    least = np.full(bins.count, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, place, mix(shingles))
    filled = np.zeros(bins.count, dtype=bool)
    filled[place] = True
    source, empty, attempt = np.arange(bins.count), np.flatnonzero(~filled), 0
    while len(empty):
        attempt += 1
        tried = mix(empty.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(attempt)) % np.uint64(bins.count)
        source[empty] = tried.astype(np.int64)
        empty = empty[~filled[source[empty]]]
    # the bin takes part, so bins that borrow one value do not agree by chance all at once
    values = mix(least[source] ^ mix(np.arange(1, bins.count + 1, dtype=np.uint64)))
    kept = (values[:, None] >> np.arange(bins.bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(kept.astype(np.uint8), bitorder="little").tobytes()


def with_fingerprint(documents: DataFrame, text: str, name: str, bins: Bins = Bins()) -> DataFrame:
    """Add the fingerprint of column ``text`` as lowercase hex in column ``name``."""

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(s, bins).hex() for _, s in shingle_sets(texts, bins.shingle)], pa.string())

    return documents.withColumn(name, of(F.col(text)))


def similarity(left: Column, right: Column, bins: Bins = Bins()) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two columns of fingerprints; null if either is null."""

    @F.arrow_udf("double")
    def of(a: pa.Array, b: pa.Array) -> pa.Array:
        chance = 0.5**bins.bits
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            if x is None or y is None:
                out.append(None)
            elif x == y or not x or not y:
                out.append(float(x == y))
            else:
                bits = np.unpackbits(
                    np.frombuffer(bytes.fromhex(x), np.uint8) ^ np.frombuffer(bytes.fromhex(y), np.uint8),
                    bitorder="little",
                )
                equal = 1 - bits.reshape(bins.count, bins.bits).any(axis=1).mean()
                out.append(float(min(1.0, max(0.0, (equal - chance) / (1 - chance)))))
        return pa.array(out, pa.float64())

    return of(left, right)


def with_next_text(documents: DataFrame, also: list[str], ranges: int | None = None) -> DataFrame:
    """Add ``next_<c>`` for ``text`` and the columns ``also``: the next row in descending ``doc_id``.

    After the last row comes the first; rows of equal ``doc_id`` follow by text, rows without
    one come last. Rows go to ranges of ids once, with the first row of each range also sent
    to the range before, so no window spans more than a range. ``ranges`` defaults to four a
    shuffle partition.
    """
    spark = documents.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = -F.col("doc_id").cast("double")
    shares = [i / ranges for i in range(1, ranges)]
    ids = documents.select(number.alias("number")).where("number is not null")
    cuts = sorted(set(ids.approxQuantile("number", shares, 0.25 / ranges)))
    ranged = Bucketizer(
        splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol="number", outputCol="range", handleInvalid="keep",
    ).transform(documents.select("doc_id", "text", *also, number.alias("number"))).drop("number")
    ranged = ranged.withColumn("range", F.coalesce(F.col("range").cast("int"), F.lit(ranges + 1)))
    # one row a range, bounded by ``ranges``
    heads = ranged.groupBy("range").agg(F.max("doc_id").alias("doc_id")).orderBy("range").collect()
    before = {r["range"]: heads[i - 1]["range"] for i, r in enumerate(heads)}
    guests = F.lit(None).cast("int")
    if heads:
        pairs = spark.createDataFrame([(r["range"], r["doc_id"], before[r["range"]]) for r in heads], "range int, head long, guest int")
        ranged = ranged.join(F.broadcast(pairs), "range")
        guests = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.col("guest"))
    own = F.struct(F.col("range").alias("at"), F.lit(0).alias("visit"))
    visit = F.struct(guests.alias("at"), F.lit(1).alias("visit"))
    sent = ranged.select("doc_id", "text", *also, F.inline(F.filter(F.array(own, visit), lambda p: p["at"].isNotNull())))
    order = Window.partitionBy("at").orderBy("visit", F.desc_nulls_last("doc_id"), "text")
    following = {f"next_{c}": F.lead(c).over(order) for c in ("text", *also)}
    return sent.withColumns(following).where("visit = 0").drop("at", "visit")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third (rounded down) replaced by as many first characters of ``following``, or all."""
    length = F.char_length(text)
    third = F.floor(length / 3).cast("int")
    return F.concat(F.left(text, length - third), F.left(following, third))


def edit_resistance(documents: DataFrame, bins: Bins = Bins()) -> DataFrame:
    """Fingerprints of all texts (null: empty) and of their edited texts, and how alike they are."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    marked = with_next_text(with_fingerprint(texts, "text", "fingerprint", bins), ["fingerprint"])
    changed = marked.withColumn("edited", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    both = with_fingerprint(changed, "edited", "edited_fingerprint", bins)
    return both.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        similarity(F.col("fingerprint"), F.col("edited_fingerprint"), bins).alias("near_edited"),
        similarity(F.col("fingerprint"), F.col("next_fingerprint"), bins).alias("near_next"),
    )
