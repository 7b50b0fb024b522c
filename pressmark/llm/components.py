"""Connected components of a table of links, by alternating large and small stars.

Each round is two joins of the links with their least neighbours; links of a node are never
gathered in one place, also not for these joins: they are dealt out by both ends. Rounds are written to the shared folder, so a lost executor repeats
one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressmark.session import stage


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``links`` (a, b); the component is its least node.

    Links of a node with itself and links with a null are ignored. No links give no rows.
    """
    ends = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = stage(links.where("a <> b").select(*ends).distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def join_spread(rows: DataFrame, unique: DataFrame, key: str, by: str, how: str = "inner", salts: int = 64) -> DataFrame:
    """Join ``unique`` on a key that may hold most of ``rows``; rows of a key are dealt out by ``by``.

    The other side goes to the parts that a key has, ``salts`` at most. ``rows`` is read twice.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    there = salted.select(key, "salt").distinct().join(unique, key)
    return salted.join(there, [key, "salt"], how).drop("salt")


def _with_least(edges: DataFrame, neighbours: DataFrame) -> DataFrame:
    """``edges`` with the least ``v`` of their ``u`` among ``neighbours``."""
    return join_spread(edges, neighbours.groupBy("u").agg(F.min("v").alias("m")), "u", "v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every greater neighbour of a node to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = _with_least(both.where("v > u"), both)
    return tied.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its lesser neighbours to the least of them."""
    lesser = _with_least(edges, edges).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("v"))
    return lesser.unionByName(least).distinct()
