"""Cut a long ordered list of items into files of limited size.

The rule is sequential: before each item, a file already larger than the limit is closed
and the next one opened. Taken literally that is one task over all items. Here it is a
composition of functions: a chunk of consecutive items maps the size of the file open
before it to the size of the file open after it and the number of files begun. Chunk
functions are small tables, computed in parallel; neighbours are composed in groups until
few are left, the true sizes are handed down again, and each chunk then numbers its items.
The result equals the sequential rule for any chunking.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from pressmark.session import stage

# workers get these functions by value, so they need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STEPS = "chunk long, above long, fixed boolean, value long, begun long"
_ENTRY = "chunk long, size long, file_no long"


@dataclass(frozen=True)
class _Chunk:
    """First item that closes the open file, for each size of it; and where each new file leads."""

    prefix: np.ndarray
    following: np.ndarray
    exit_size: np.ndarray
    begun: np.ndarray


def _chunk(sizes: np.ndarray, limit: int, header: int) -> _Chunk:
    n = len(sizes)
    prefix = np.concatenate(([0], np.cumsum(sizes)))
    starts = np.arange(n)
    following = np.searchsorted(prefix, limit - header + prefix[:-1], side="right")
    following = np.minimum(np.maximum(following, starts + 1), n)
    exit_size = header + prefix[n] - prefix[:-1]
    begun = np.ones(n, dtype=np.int64)
    for j in range(n - 1, -1, -1):
        if following[j] < n:
            exit_size[j] = exit_size[following[j]]
            begun[j] = begun[following[j]] + 1
    return _Chunk(prefix, following, exit_size, begun)


def _merge(above: np.ndarray, fixed: np.ndarray, value: np.ndarray, begun: np.ndarray) -> pd.DataFrame:
    """Ascending steps, equal neighbours joined."""
    change = (fixed[1:] != fixed[:-1]) | (value[1:] != value[:-1]) | (begun[1:] != begun[:-1])
    keep = np.concatenate(([True], change))
    return pd.DataFrame({"above": above[keep], "fixed": fixed[keep], "value": value[keep], "begun": begun[keep]})


def _steps_of(chunk: _Chunk, limit: int, header: int) -> pd.DataFrame:
    n = len(chunk.begun)
    thresholds = limit - chunk.prefix[:n]
    # an open file holds its header at least, so lower thresholds are never reached
    used = min(n, int(np.searchsorted(-thresholds, -(header - 1), side="left")) + 1)
    above, value, begun = thresholds[:used][::-1], chunk.exit_size[:used][::-1], chunk.begun[:used][::-1]
    fixed = np.ones(used, dtype=bool)
    if above[0] >= header:
        above, fixed = np.concatenate(([-1], above)), np.concatenate(([False], fixed))
        value, begun = np.concatenate(([chunk.prefix[n]], value)), np.concatenate(([0], begun))
    else:
        above = np.concatenate(([-1], above[1:]))
    return _merge(above, fixed, value, begun)


def _apply(steps: pd.DataFrame, size: int) -> tuple[int, int]:
    row = int(np.searchsorted(steps["above"].to_numpy(), size, side="left")) - 1
    value = int(steps["value"].iat[row])
    return (value if steps["fixed"].iat[row] else size + value), int(steps["begun"].iat[row])


def _compose(first: pd.DataFrame, then: pd.DataFrame) -> pd.DataFrame:
    """Steps of ``then`` after ``first``."""
    edges = then["above"].to_numpy()
    above, fixed, value, begun = [], [], [], []
    lows = first["above"].to_numpy()
    highs = np.append(lows[1:], np.iinfo(np.int64).max)
    for low, high, is_fixed, v, b in zip(lows, highs, first["fixed"], first["value"], first["begun"]):
        if is_fixed:
            rows = [(low, int(np.searchsorted(edges, v, side="left")) - 1)]
        else:
            inside = [(edge - v, i) for i, edge in enumerate(edges) if low < edge - v < high]
            rows = [(low, int(np.searchsorted(edges, low + v + 1, side="left")) - 1), *inside]
        for edge, i in rows:
            constant = bool(then["fixed"].iat[i])
            shift = int(then["value"].iat[i])
            above.append(edge)
            fixed.append(constant or bool(is_fixed))
            value.append(shift if constant else v + shift)
            begun.append(b + int(then["begun"].iat[i]))
    return _merge(np.array(above), np.array(fixed), np.array(value), np.array(begun))


def _by_chunk(steps: pd.DataFrame) -> list[tuple[int, pd.DataFrame]]:
    columns = ["above", "fixed", "value", "begun"]
    ordered = steps.sort_values(["chunk", "above"])
    return [(int(number), part[columns].reset_index(drop=True)) for number, part in ordered.groupby("chunk")]


def assign_shards(
    items: DataFrame,
    limit: int,
    header: int,
    chunk_rows: int = 50_000,
    fan_in: int = 256,
) -> DataFrame:
    """Add ``file_no`` to items with a dense ``position`` and their size in ``bytes``.

    Every group handed to a task holds ``chunk_rows`` items or ``fan_in`` step tables, however
    many items there are. Pass the two columns and a key only.
    """
    chunked = stage(items.withColumn("chunk", F.floor(F.col("position") / chunk_rows).cast("long")), "sizes")

    def steps(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows.sort_values("position")["bytes"].to_numpy()
        return _steps_of(_chunk(sizes, limit, header), limit, header).assign(chunk=key[0])

    narrow = chunked.select("chunk", "position", "bytes")
    levels = [stage(narrow.groupBy("chunk").applyInPandas(steps, _STEPS), "steps")]
    chunks = chunked.agg(F.max("chunk")).first()[0]
    count = 0 if chunks is None else chunks + 1

    def composed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [part for _, part in _by_chunk(rows)]
        whole = parts[0]
        for part in parts[1:]:
            whole = _compose(whole, part)
        return whole.assign(chunk=key[0])

    def parent(level: DataFrame) -> DataFrame:
        return level.withColumn("parent", F.floor(F.col("chunk") / fan_in).cast("long"))

    while count > fan_in:
        levels.append(stage(parent(levels[-1]).groupBy("parent").applyInPandas(composed, _STEPS), "steps"))
        count = -(-count // fan_in)

    def handed_down(key: tuple, rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        size, number = (int(entry["size"].iat[0]), int(entry["file_no"].iat[0])) if len(entry) else (header, 0)
        out = []
        for chunk, part in _by_chunk(rows):
            out.append((chunk, size, number))
            size, begun = _apply(part, size)
            number += begun
        return pd.DataFrame(out, columns=["chunk", "size", "file_no"])

    spark = items.sparkSession
    entries = spark.createDataFrame([(0, header, 0)], _ENTRY)
    for level in reversed(levels):
        group = parent(level).groupBy("parent").cogroup(entries.groupBy("chunk"))
        entries = group.applyInPandas(handed_down, _ENTRY)

    def numbered(key: tuple, rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        chunk = _chunk(rows["bytes"].to_numpy(), limit, header)
        n = len(rows)
        over = chunk.prefix[:n] > limit - int(entry["size"].iat[0])
        begins, at = [], int(np.argmax(over)) if over.any() else n
        while at < n:
            begins.append(at)
            at = int(chunk.following[at])
        file_no = int(entry["file_no"].iat[0]) + np.searchsorted(begins, np.arange(n), side="right")
        return pd.DataFrame({"position": rows["position"], "file_no": file_no})

    numbers = narrow.groupBy("chunk").cogroup(entries.groupBy("chunk")).applyInPandas(
        numbered, "position long, file_no long"
    )
    return chunked.drop("chunk").join(numbers, "position")
