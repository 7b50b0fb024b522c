"""Near-duplicates by b-bit MinHash.

Every document is the set of its distinct shingles of five words. Equal sets are one class
with one representative. ``SIGNATURE`` minima per set are cut into bands; sets that agree on
a band are candidates, and the low bits of all minima, packed, give a similarity corrected
for chance agreement by counting equal groups of bits. Links are confirmed on the full sets.
Connected components of confirmed links are the groups.

Large groups come first, in proportion to their size: every band names one of its sets as its
star, every set is compared with the stars of its bands, and the likeliest one is confirmed
(``stars`` rounds, each with other stars). After them, only sets of one band that lie in
different components can still add a link. All such pairs are compared, without exception:
the largest component of a band meets the rest of the band, not itself, in pairs of blocks
of at most about ``block`` sets, and blocks of large sets hold fewer. Chains of likely pairs
bound where links can be, and are confirmed in blocks in the same way. So m sets that are
alike cost about m rows; m sets that share a band and are not linked cost m^2 / ``block``.

No task holds a whole group, and a task returns a spanning forest of its links, not the
links. Memory of a task: one pair of blocks, or the texts of one star.

Defined results: null or wordless texts have an empty set and are linked with nothing.
Repeated rows and equal texts share a component. Rows that share a ``doc_id`` are one
document: texts of it that differ link their groups. Rows without a ``doc_id`` have no
component and are kept. An empty table gives an empty result. Only ``doc_id`` and ``text``
are read, other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressmark.llm.components import connected_components, join_spread
from pressmark.llm.words import SHINGLE, mix, shingle_sets
from pressmark.session import stage


@dataclass(frozen=True)
class MinHash:
    """Similarity in hundredths, bands times rows of minima, low bits kept, sets and shingles per block, rounds of stars.

    25 bands of 5 miss a pair at similarity 0.85 with probability 4e-7, 28 bands of 4 one at
    0.80 as often; the estimate is held against the threshold less five standard deviations.
    ``signature`` times ``bits`` is a multiple of 64, ``signature`` at least bands times rows.
    """

    percent: int = 85
    bands: int = 25
    rows: int = 5
    signature: int = 128
    bits: int = 4
    block: int = 128
    block_shingles: int = 2**19
    stars: int = 2
    shingle: int = SHINGLE

    @property
    def chance(self) -> float:
        return 0.5**self.bits

    def estimate(self, equal: np.ndarray) -> np.ndarray:
        """Similarity from the number of equal low bit groups, less what agrees by chance."""
        return (equal / self.signature - self.chance) / (1 - self.chance)

    @property
    def least_equal(self) -> float:
        """Equal groups below which a pair cannot be at the threshold."""
        share = self.percent / 100
        share -= 5 * (share * (1 - share) / self.signature) ** 0.5
        return (share * (1 - self.chance) + self.chance) * self.signature


@lru_cache(maxsize=4)
def _families(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
    return (seeds[:count] >> np.uint64(32)).astype(np.uint32), (seeds[count:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minima(shingles: np.ndarray, count: int) -> np.ndarray:
    """The least value of a set under each of ``count`` permutations of 32-bit values."""
    masks, factors = _families(count)
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(folded), 2048):
        part = folded[None, i : i + 2048] ^ masks[:, None]
        part *= factors[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def low_bits(least: np.ndarray, bits: int) -> bytes:
    """The low bits of the mixed minima, packed."""
    kept = mix(least.astype(np.uint64) + np.uint64(1)) & np.uint64(2**bits - 1)
    unpacked = (kept[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(unpacked.astype(np.uint8), bitorder="little").tobytes()


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    value = mix(np.arange(bands, dtype=np.uint64) + np.uint64(77))
    for column in least[: bands * rows].reshape(bands, rows).T.astype(np.uint64):
        value = mix(value ^ (column + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    return value.view(np.int64)


def equal_groups(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Of packed signatures (rows of 64-bit words): equal groups of ``bits`` for every left and right."""
    return _equal(left[:, None, :] ^ right[None, :, :], bits)


def _equal(differ: np.ndarray, bits: int) -> np.ndarray:
    folded, width = differ, 1
    while width < bits:
        folded = folded | (folded >> np.uint64(width))
        width *= 2
    lowest = np.uint64(sum(1 << i for i in range(0, 64, bits)))
    unequal = np.bitwise_count(folded & lowest).sum(axis=-1, dtype=np.int64)
    return differ.shape[-1] * (64 // bits) - unequal


def _signed(batches: Iterator[pa.RecordBatch], settings: MinHash) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands, packed = [], [], [], []
        for _, shingles in shingle_sets(batch.column("text"), settings.shingle):
            sizes.append(len(shingles))
            keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
            least = minima(shingles, settings.signature) if len(shingles) else None
            bands.append(None if least is None else band_keys(least, settings.bands, settings.rows))
            packed.append(None if least is None else low_bits(least, settings.bits))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
            names=["doc_id", "n_shingles", "set_key", "bands", "packed"],
        )


def _forest(linked: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of an adjacency matrix; trees hang from their least id."""
    order, edges = np.argsort(ids, kind="stable"), []
    open_ = linked.any(axis=1)
    for root in order:
        if not open_[root]:
            continue
        open_[root], todo = False, [root]
        while todo:
            found = np.flatnonzero(linked[todo.pop()] & open_)
            open_[found] = False
            todo.extend(found)
            edges.extend((int(ids[i]), int(ids[root])) for i in found if ids[i] != ids[root])
    return edges


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, also across batches."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        changes = np.zeros(table.num_rows, dtype=bool)
        for key in keys:
            values = table.column(key).to_numpy()
            changes[1:] |= values[1:] != values[:-1]
            if held and held[-1].column(key)[-1].as_py() != values[0]:
                changes[0] = True
        at = [0, *np.flatnonzero(changes), table.num_rows]
        for begin, end in zip(at, at[1:]):
            if changes[begin] and held:
                yield pa.concat_tables(held)
                held = []
            if end > begin:
                held.append(table.slice(begin, end - begin))
    if held:
        yield pa.concat_tables(held)


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edge_batches(groups: Iterator[list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []
    for edges in groups:
        held.extend(edges)
        if len(held) >= 10_000:
            yield _edge_batch(held)
            held = []
    yield _edge_batch(held)


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = zip(*edges) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_EDGES)


def _across(table: pa.Table) -> np.ndarray:
    """Which pairs of rows belong to this pair of blocks and may join components."""
    block, component = table.column("block").to_numpy(), table.column("component").to_numpy()
    apart = component[:, None] != component[None, :]
    if table.column("i")[0].as_py() != table.column("j")[0].as_py():
        apart &= block[:, None] != block[None, :]
    return apart


def _words(packed: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Packed signatures as rows of 64-bit words."""
    return np.frombuffer(b"".join(packed.to_pylist()), dtype="<u8").reshape(len(packed), -1)


def _similar_sizes(least: np.ndarray, most: np.ndarray, settings: MinHash) -> np.ndarray:
    return 100 * least >= settings.percent * most


def _alike(batches: Iterator[pa.RecordBatch], settings: MinHash) -> Iterator[pa.RecordBatch]:
    """Likely ones of pairs of a set and a star, with their equal groups."""
    for batch in batches:
        if not batch.num_rows:
            continue
        equal = _equal(_words(batch.column("packed")) ^ _words(batch.column("star_packed")), settings.bits)
        own, other = batch.column("n_shingles").to_numpy(), batch.column("star_shingles").to_numpy()
        likely = (equal >= settings.least_equal) & _similar_sizes(np.minimum(own, other), np.maximum(own, other), settings)
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), batch.column("star"), pa.array(equal)], names=["rep", "star", "equal"]
        ).filter(pa.array(likely))


def _with_star(batches: Iterator[pa.RecordBatch], settings: MinHash) -> Iterator[pa.RecordBatch]:
    """Confirmed links of sets with their star, whose own texts come first; only these are held."""
    place, leads = None, []
    for batch in (part for whole in batches for part in _slices(whole)):
        edges = []
        for star, salt, rep, lead, packed in zip(*(batch.column(c).to_pylist() for c in ("star", "salt", "rep", "lead", "shingles"))):
            if (star, salt) != place:
                place, leads = (star, salt), []
            own = np.frombuffer(packed, dtype="<u8")
            if lead:
                if not any(np.array_equal(own, other) for other in leads):
                    leads.append(own)
                continue
            for other in leads:
                small, large = sorted((own, other), key=len)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                if 100 * common >= settings.percent * (len(own) + len(other) - common):
                    edges.append((rep, star))
                    break
        yield _edge_batch(edges)


def _likely(batches: Iterator[pa.RecordBatch], settings: MinHash) -> Iterator[pa.RecordBatch]:
    def edges(table: pa.Table) -> list[tuple[int, int]]:
        ids, sizes = table.column("rep").to_numpy(), table.column("n_shingles").to_numpy()
        words = _words(table.column("packed"))
        linked = equal_groups(words, words, settings.bits) >= settings.least_equal
        linked &= _similar_sizes(np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes), settings)
        return _forest(linked & _across(table), ids)

    return _edge_batches(edges(g) for g in groups_of(batches, ["key", "i", "j"]) if g.num_rows > 1)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets."""
    counts = np.zeros((len(sets), len(sets)))
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(place, minlength=len(values)) > 1  # a value of one set adds to no pair
    column = np.cumsum(shared) - 1
    keep = shared[place]
    rows, place = rows[keep], column[place[keep]]
    order = np.argsort(place, kind="stable")
    rows, place = rows[order], place[order]
    for begin in range(0, int(shared.sum()), 8192):
        low, high = np.searchsorted(place, [begin, begin + 8192])
        part = np.zeros((len(sets), 8192), dtype=np.float32)
        part[rows[low:high], place[low:high] - begin] = 1
        counts += part @ part.T
    return counts.astype(np.int64)


def _confirmed(batches: Iterator[pa.RecordBatch], settings: MinHash) -> Iterator[pa.RecordBatch]:
    def edges(table: pa.Table) -> list[tuple[int, int]]:
        ids = table.column("rep").to_numpy()
        sets = [np.frombuffer(s, dtype="<u8") for s in table.column("shingles").to_pylist()]
        sizes, common = np.array([len(s) for s in sets]), _common(sets)
        linked = 100 * common >= settings.percent * (sizes[:, None] + sizes[None, :] - common)
        return _forest(linked & _across(table), ids)

    return _edge_batches(edges(g) for g in groups_of(batches, ["key", "i", "j"]) if g.num_rows > 1)


def _sets(batches: Iterator[pa.RecordBatch], settings: MinHash) -> Iterator[pa.RecordBatch]:
    """The column ``text`` replaced by the set of its shingles, some rows at a time."""
    for batch in batches:
        for part in _slices(batch):
            packed = [s.tobytes() for _, s in shingle_sets(part.column("text"), settings.shingle)]
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), pa.array(packed, pa.binary())], names=[*kept, "shingles"])


def _slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _sets_of(texts: DataFrame, wanted: DataFrame, settings: MinHash) -> DataFrame:
    """``wanted`` (rep and others) with the sets of the texts of ``rep``."""
    joined = texts.join(wanted, texts["doc_id"] == wanted["rep"]).select(*wanted.columns, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema)
    return joined.mapInArrow(partial(_sets, settings=settings), f"{schema}, shingles binary")


def _apart(members: DataFrame, settings: MinHash) -> DataFrame:
    """Members (key, rep, component, n_shingles) of keys with several components, with numbers of blocks.

    ``bulk`` marks the largest component of a key, which fills ``bulks`` blocks; the others fill ``rests``.
    """
    parts = members.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    keys = parts.groupBy("key").agg(
        F.max(F.struct("n", "component", "shingles")).alias("most"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles")
    ).where("n > most.n")

    def blocks(n: str, shingles: str) -> Column:
        return F.greatest(F.ceil(F.expr(n) / settings.block), F.ceil(F.expr(shingles) / settings.block_shingles)).cast("int")

    keys = keys.select(
        "key", F.col("most.component").alias("most"), blocks("most.n", "most.shingles").alias("bulks"),
        blocks("n - most.n", "shingles - most.shingles").alias("rests"),
    )
    return join_spread(members, keys, "key", "rep").withColumn("bulk", F.col("component") == F.col("most")).drop("most")


def _in_block_pairs(apart: DataFrame) -> DataFrame:
    """Deal members to the pairs of blocks of which one at least is of the rest; pairs together."""
    blocks = F.when(F.col("bulk"), F.col("bulks")).otherwise(F.col("rests"))
    block = F.pmod(F.xxhash64("rep"), blocks) + F.when(F.col("bulk"), 0).otherwise(F.col("bulks"))
    first = F.when(F.col("bulk"), F.col("bulks")).otherwise(0)
    dealt = apart.withColumn("block", block.cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(first, F.col("bulks") + F.col("rests") - 1)))
    paired = paired.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    paired = paired.drop("other", "bulk", "bulks", "rests")
    return paired.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _named(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with their component under these links, of keys that hold several components."""
    components = connected_components(links).withColumnRenamed("node", "rep")
    named = members.drop("component").join(components, "rep", "left")
    return named.withColumn("component", F.coalesce("component", "rep"))


def _star_links(texts: DataFrame, members: DataFrame, classes: DataFrame, turn: int, settings: MinHash) -> DataFrame:
    """Confirmed links of each set with the likeliest of the stars of its keys that lie in other components."""
    # drawn by the set alone, so bands of the same sets name the same star and few pairs are left
    drawn = F.xxhash64("rep", F.lit(turn))
    stars = members.groupBy("key").agg(F.min_by("rep", drawn).alias("star"), F.min_by("component", drawn).alias("lead"))
    pairs = join_spread(members, stars, "key", "rep").where("component <> lead").select("rep", "star").distinct()
    pairs = stage(pairs, "star_pairs")
    other = classes.select(F.col("rep").alias("star"), F.col("packed").alias("star_packed"), F.col("n_shingles").alias("star_shingles"))
    signed = join_spread(pairs, other, "star", "rep").join(classes.select("rep", "packed", "n_shingles"), "rep")
    likely = signed.select("rep", "star", "packed", "star_packed", "n_shingles", "star_shingles")
    likely = likely.mapInArrow(partial(_alike, settings=settings), "rep long, star long, equal long")
    best = likely.groupBy("rep").agg(F.max(F.struct("equal", "star")).alias("best")).select("rep", "best.star")
    best = stage(best.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(64))), "stars")
    # a star goes once to every salt of its sets, and each wanted text is cut into shingles once
    own = best.select("rep", "star", "salt", F.lit(False).alias("lead"))
    lead = best.select(F.col("star").alias("rep"), "star", "salt", F.lit(True).alias("lead")).distinct()
    wanted = own.unionByName(lead).groupBy("rep").agg(F.collect_list(F.struct("star", "salt", "lead")).alias("places"))
    sets = _sets_of(texts, wanted, settings).select("rep", F.explode("places").alias("place"), "shingles")
    sets = sets.select("place.star", "place.salt", "rep", "place.lead", "shingles").repartition("star", "salt")
    sets = sets.sortWithinPartitions("star", "salt", F.col("lead").desc())
    return sets.mapInArrow(partial(_with_star, settings=settings), "a long, b long")


def near_duplicates(documents: DataFrame, settings: MinHash = MinHash()) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the least ``doc_id`` that links reach; ``kept`` marks that document.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(
        texts.mapInArrow(
            partial(_signed, settings=settings),
            "doc_id long, n_shingles long, set_key binary, bands array<long>, packed binary",
        ),
        "signatures",
    )
    found = signed.where("doc_id is not null and n_shingles > 0")
    classes = stage(
        found.groupBy("set_key").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), F.first("packed").alias("packed"),
        ),
        "classes",
    )
    # several texts of one doc_id
    own = found.select("doc_id", "set_key").distinct()
    several = own.join(own.groupBy("doc_id").count().where("count > 1").select("doc_id"), "doc_id")
    several = several.join(classes.select("set_key", "rep"), "set_key").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = stage(several, "several")
    # bands that several sets share
    keyed = classes.select("rep", "n_shingles", F.explode("bands").alias("key"))
    shared = stage(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "bands")
    members = stage(_named(keyed.join(shared.select("key"), "key"), links), "members")
    for turn in range(settings.stars):
        links = links.unionByName(stage(_star_links(texts, members, classes, turn, settings), "star_links"))
        named = stage(_named(members, links), "named")
        members = stage(_apart(named, settings).select("key", "rep", "n_shingles", "component"), "members")
    # what is still apart: likely pairs on signatures, then within their chains on the sets of the whole texts
    apart = _apart(members, settings).join(classes.select("rep", "packed"), "rep")
    likely = _in_block_pairs(apart).mapInArrow(partial(_likely, settings=settings), "a long, b long")
    chains = connected_components(likely).select(F.col("component").alias("key"), F.col("node").alias("rep"))
    known = members.groupBy("rep").agg(F.first("component").alias("component"), F.max("n_shingles").alias("n_shingles"))
    chained = stage(_apart(stage(chains.join(known, "rep"), "chains"), settings), "chained")
    confirmed = _in_block_pairs(_sets_of(texts, chained, settings))
    confirmed = confirmed.mapInArrow(partial(_confirmed, settings=settings), "a long, b long")
    components = connected_components(links.unionByName(confirmed))
    reached = classes.select("set_key", "rep").join(
        components.withColumnRenamed("node", "rep"), "rep", "left"
    ).select("set_key", F.coalesce("component", "rep").alias("component_id"))
    result = join_spread(signed.select("doc_id", "n_shingles", "set_key"), stage(reached, "reached"), "set_key", "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(documents: DataFrame, settings: MinHash = MinHash()) -> DataFrame:
    """The rows of ``documents``, one document of each group, with all their columns.

    Of rows that share a kept ``doc_id`` the one with the least text stays. Rows without a
    ``doc_id`` stay.
    """
    # ids are stored, so that Spark's size check knows them and sends them to the texts, which then stay where they are
    dropped = stage(near_duplicates(documents, settings).where("not kept").select("doc_id").distinct(), "dropped")
    alike = documents.join(dropped, "doc_id", "left_anti").select(documents.columns)
    repeated = documents.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    repeated = stage(repeated, "repeated")
    if repeated.isEmpty():
        return alike
    once = alike.join(repeated, "doc_id", "left_anti").select(documents.columns)
    several = alike.join(repeated, "doc_id", "left_semi").groupBy("doc_id")
    least = several.agg(F.min_by(F.struct(*documents.columns), F.struct("text")).alias("least"))
    return once.unionByName(least.select("least.*"))
