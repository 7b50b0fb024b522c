"""Chat formatting after collapse of cumulative snapshots. DataFrame functions only.

A logger that writes a conversation anew after every turn leaves prefixes of longer ones. Turns
are numbered within a conversation; each has a 128-bit hash of its number, role and text, and
the exclusive or of the hashes up to a turn is the hash of that prefix. The last one is the
conversation's. Conversations of equal length and hash are one; those whose hash is that of
a shorter prefix of another are dropped by an anti-join. What remains is rendered.

Joins and groups use lengths and hashes alone. A first turn that a third of all conversations
share is one row after partial aggregation. Only turns of one conversation meet in one place.

Defined results: turns are ordered by number and role (nulls first), then by the MD5 sum of the
text (no text first); gaps in the numbers do not matter. Rows that repeat a turn's number, role and text
count once. A null role is rendered as ``unknown`` and a null text as empty, but neither is
equal to those in comparison. Rows without a conversation id are ignored. Of equal
conversations the least id stays, ``copies`` counts them. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def _hashed(turns: DataFrame) -> DataFrame:
    """Turns with two independent hashes of role and text, and a key that orders turns of equal number and role."""
    present = F.col("role").isNull(), F.col("text").isNull()
    one, two = F.xxhash64(F.lit(1), *present, "role", "text"), F.xxhash64(F.lit(2), "text", "role", *present)
    tie = F.unhex(F.md5(F.col("text").cast("binary"))).alias("tie")
    return turns.where("conv_id is not null").select("conv_id", "turn", "role", "text", tie, one.alias("x"), two.alias("y"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, n, a, b, last): the hash of the first ``n`` turns of each conversation."""
    narrow = _hashed(turns).select("conv_id", "turn", "role", "tie", "x", "y").distinct()
    order = Window.partitionBy("conv_id").orderBy(*[F.asc_nulls_first(c) for c in ("turn", "role", "tie")])
    numbered = narrow.select("conv_id", "x", "y", F.row_number().over(order).alias("n"))
    salted = numbered.select("conv_id", "n", F.xxhash64("n", "x", "y").alias("x"), F.xxhash64("y", "x", "n").alias("y"))
    turn = Window.partitionBy("conv_id").orderBy("n")
    running = turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return salted.select(
        "conv_id", "n", F.bit_xor("x").over(running).alias("a"), F.bit_xor("y").over(running).alias("b"),
        F.lead("n").over(turn).isNull().alias("last"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, n_turns, copies) of the conversations that are no prefix of a longer one."""
    prefixes = prefix_hashes(turns)
    whole = prefixes.where("last").groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = prefixes.where("not last").select("n", "a", "b").distinct()
    return whole.join(inner, ["n", "a", "b"], "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"), "copies")


def rendered(turns: DataFrame, begin: str = "<|{role}|>\n", end: str = "<|end|>\n") -> DataFrame:
    """Rows (conv_id, n_turns, copies, chat): maximal conversations as text.

    ``{role}`` in ``begin`` and ``end`` stands for the role of a turn; every text ends with a line feed.
    """
    kept = maximal(turns)
    rows = _hashed(turns).select("conv_id", F.struct("turn", "role", "tie", "text").alias("t")).join(kept, "conv_id")
    grouped = rows.groupBy("conv_id").agg(
        F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"), F.collect_list("t").alias("turns")
    )

    def turn(t):
        role = F.coalesce(t["role"], F.lit("unknown"))
        return F.concat(
            F.replace(F.lit(begin), F.lit("{role}"), role), F.coalesce(t["text"], F.lit("")), F.lit("\n"),
            F.replace(F.lit(end), F.lit("{role}"), role),
        )

    ordered = F.array_distinct(F.sort_array("turns"))
    return grouped.select("conv_id", "n_turns", "copies", F.array_join(F.transform(ordered, turn), "").alias("chat"))


#: The same as DuckDB SQL, comparing the turns themselves.
ORACLE = r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
chats AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(text) NULLS FIRST) AS turns, count(*) AS n
  FROM turns GROUP BY conv_id
), whole AS (
  SELECT turns, n, min(conv_id) AS conv_id, count(*) AS copies FROM chats GROUP BY turns, n
), kept AS (
  SELECT * FROM whole AS w WHERE NOT EXISTS (
    SELECT 1 FROM whole AS longer WHERE longer.n > w.n AND longer.turns[1] = w.turns[1] AND longer.turns[1:w.n] = w.turns)
)
SELECT conv_id, n AS n_turns, copies,
       array_to_string(list_transform(turns, lambda t:
         '<|' || coalesce(t.role, 'unknown') || '|>' || chr(10) || coalesce(t.text, '') || chr(10) || '<|end|>' || chr(10)), '') AS chat
FROM kept"""
