"""Quality rules as a ledger: measurements and a bit for every rule that fails.

Every rule is evaluated once for every document. The ledger keeps the measurements and one number,
``failures``, whose bit b is set where the rule of place b fails. Policies are named, versioned sets of
rules; whether a policy keeps a document is a mask over that number, so policies can be changed and
compared without looking at a text again. Ablations ask what each rule of a policy does: how many documents fail it,
how many only it rejects, and how many would be kept without it. They are bitwise arithmetic
over the distinct numbers and their counts, of which there are at most two to the number of rules.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return; texts are measured whole, upper case apart from lower. Words and three-word windows are
compared by 64-bit hashes. Lines are parted by line feeds and compared exactly.

Defined results: a null, empty or blank text has measurements of 0 and fails the rules that ask
for a least number. Equal texts have equal rows; rows that repeat a ``doc_id`` stay. An
empty table gives no rows. A null doc_id stays null. One very long text takes a task about 60 bytes a word.
Other columns may have any name: only ``doc_id`` and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressmark.llm.words import EXACT_VALUES, SPACE, mix, row_chunks, word_hashes

MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words")
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_BLANK = b" \t\n\x0b\x0c\r"
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition on the measurements. Its place in the list of rules is its bit."""

    name: str
    fails: str


# Conditions are on integers, so they mean the same on every engine. New rules are added at the end: bits are kept.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_words", "n_words > 1000000"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("few_letters", "100 * n_letter_words < 60 * n_words"),
)
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A document is kept that fails at most ``allowed`` of the named rules and none of ``always``."""

    name: str
    version: int
    rules: tuple[str, ...]
    allowed: int = 0
    always: tuple[str, ...] = BASE


STRICT = Policy("prose", 1, tuple(rule.name for rule in RULES))
# one weak sign alone is forgiven, two are not
LENIENT = Policy("prose", 2, tuple(rule.name for rule in RULES), allowed=1)


def mask_of(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    places = {rule.name: i for i, rule in enumerate(rules)}
    return reduce(lambda mask, name: mask | 1 << places[name], names, 0)


def _per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if len(offsets) == 2:
        return np.array([np.count_nonzero(marks)])
    sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words of each row that are in a three-word window found twice or more in the row."""
    n = len(words)
    covered = np.zeros(n, dtype=bool)
    if n > 2:
        row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        first = np.flatnonzero(row[2:] == row[:-2])
        own = mix(row[first].astype(np.uint64) + np.uint64(1))  # a window is compared within its row only
        for i in range(3):
            own = mix(own * np.uint64(0x9E3779B97F4A7C15) + words[first + i])
        _, which, times = np.unique(own, return_inverse=True, return_counts=True)
        first = first[times[which] > 1]
        for i in range(3):
            covered[first + i] = True
    return _per_row(covered, starts)


def _lines(text: bytes) -> tuple[int, int]:
    lines = [line for line in text.split(b"\n") if line.strip(_BLANK)]
    return len(lines), len(lines) - len(set(lines))


def measure(column: pa.Array) -> Iterator[np.ndarray]:
    """Rows of measurements, in the order of ``MEASUREMENTS``, for runs of texts."""
    for _, data, offsets in row_chunks(column):
        words, starts = word_hashes(data, offsets, values=EXACT_VALUES)
        space = SPACE[data]
        chars = _per_row(~space & ((data & 0xC0) != 0x80), offsets)
        lettered = _lettered(data, space, offsets)
        lines = [_lines(data[offsets[i] : offsets[i + 1]].tobytes()) for i in range(len(offsets) - 1)]
        lines = np.array(lines, dtype=np.int64).reshape(len(lines), 2)
        yield np.column_stack([
            np.diff(starts), chars, _per_row(_SYMBOL[data], offsets), lines, _repeated(words, starts), lettered,
        ])


def _lettered(data: np.ndarray, space: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each row that hold a letter of A-Z or a character beyond ASCII."""
    if not len(data):
        return np.zeros(len(offsets) - 1, dtype=np.int64)
    # the first letter of a word is one without a letter between it and the last space or row start before it
    letter = _LETTER[data]
    events = np.flatnonzero(letter | space)
    is_letter = letter[events]
    row = np.searchsorted(offsets, events, side="right")
    first = is_letter.copy()
    first[1:] &= ~is_letter[:-1] | (row[1:] != row[:-1])
    return np.bincount(row[first] - 1, minlength=len(offsets) - 1)


def measurements(text: Column) -> Column:
    """An array of the measurements of a text column."""

    @F.arrow_udf("array<long>")
    def of(texts: pa.Array) -> pa.Array:
        rows = np.concatenate([*measure(texts), np.zeros((0, len(MEASUREMENTS)), dtype=np.int64)]).astype(np.int64)
        offsets = np.arange(0, rows.size + 1, len(MEASUREMENTS), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))

    return of(text)


def ledger(documents: DataFrame, text: str = "text", key: str = "doc_id", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: the key, all measurements, and ``failures``."""
    measured = documents.select(F.col(key).alias(key), measurements(F.col(text)).alias("_m"))
    named = measured.select(key, *[F.col("_m")[i].alias(name) for i, name in enumerate(MEASUREMENTS)])
    bits = [F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(0).cast("long") for i, rule in enumerate(rules)]
    return named.withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long")))


def keeps(failures: Column, policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a policy keeps a document, from its failure bits."""
    allowed = F.bit_count(failures.bitwiseAND(mask_of(policy.rules, rules))) <= policy.allowed
    return (failures.bitwiseAND(mask_of(policy.always, rules)) == 0) & allowed


def ablations(rows: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] = RULES) -> DataFrame:
    """What every rule of every policy does, over a ledger.

    ``documents``, ``kept``: all and those the policy keeps; ``failed``: those that fail the rule;
    ``only``: rejected ones that fail no other rule of the policy; ``without``: kept if the policy had not the rule.
    Rows are first counted by their bits, so no more rows than there are sets of bits are looked at twice.
    """
    counts = rows.groupBy("failures").agg(F.count("*").alias("n"))
    bits = F.col("failures")
    cases = []
    for policy in policies:
        mask = mask_of(policy.rules, rules) | mask_of(policy.always, rules)
        for name in policy.rules:
            bit = mask_of([name], rules)
            fewer = Policy(
                policy.name, policy.version, tuple(r for r in policy.rules if r != name), policy.allowed,
                tuple(r for r in policy.always if r != name),
            )
            cases.append(F.struct(
                F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), F.lit(name).alias("rule"),
                keeps(bits, policy, rules).alias("kept"), (bits.bitwiseAND(bit) != 0).alias("failed"),
                (~keeps(bits, policy, rules) & (bits.bitwiseAND(mask) == bit)).alias("only"),
                keeps(bits, fewer, rules).alias("without"),
            ))
    every = counts.select("n", F.inline(F.array(*cases)))
    return every.groupBy("policy", "version", "rule").agg(
        F.sum("n").alias("documents"),
        *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("kept", "failed", "only", "without")],
    )


def judged(documents: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """One row per document: doc_id, the measurements, failures, base_failed, kept, policy and its version."""
    rows = ledger(documents)
    return rows.withColumns({
        "base_failed": F.col("failures").bitwiseAND(mask_of(BASE)) != 0,
        "kept": keeps(F.col("failures"), policy),
        "policy": F.lit(f"{policy.name}-{policy.version}"),
    })


def oracle(policy: Policy = STRICT, rules: Sequence[Rule] = RULES) -> str:
    """The same in SQL, word by word."""
    bits = " | ".join(f"(CASE WHEN {rule.fails} THEN {1 << i} ELSE 0 END)" for i, rule in enumerate(rules))
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, text, regexp_extract_all(text, '{word}') AS words FROM d),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
three AS (SELECT r, i, lead(i, 2) OVER p IS NOT NULL AS whole, [word, lead(word, 1) OVER p, lead(word, 2) OVER p] AS three
          FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i, whole AND count(*) OVER (PARTITION BY r, whole, three) > 1 AS hit FROM three),
covered AS (SELECT r, hit OR coalesce(lag(hit, 1) OVER p, false) OR coalesce(lag(hit, 2) OVER p, false) AS c
            FROM twice WINDOW p AS (PARTITION BY r ORDER BY i)),
repeats AS (SELECT r, count(*) FILTER (WHERE c)::BIGINT AS n_repeat_words FROM covered GROUP BY r),
lines AS (SELECT r, count(*)::BIGINT AS n_lines, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{word}') GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]')))::BIGINT AS n_letter_words
      FROM split LEFT JOIN repeats USING (r) LEFT JOIN lines USING (r)),
b AS (SELECT *, ({bits})::BIGINT AS failures FROM m)
SELECT *, (failures & {mask_of(BASE, rules)}) <> 0 AS base_failed,
       (failures & {mask_of(policy.always, rules)}) = 0 AND bit_count(failures & {mask_of(policy.rules, rules)}) <= {policy.allowed} AS kept,
       '{policy.name}-{policy.version}' AS policy
FROM b
"""
