"""Sizes of image files, read from their headers. Nothing is decoded and no file is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NOT_AN_IMAGE = "no image of a known kind"
TRUNCATED = "image ends before its size"

_SIZE = "struct<width: int, height: int>"
# Markers of a JPEG file that hold its size, that have no length, and after which no size can follow.
_FRAMES = "'C0', 'C1', 'C2', 'C3', 'C5', 'C6', 'C7', 'C9', 'CA', 'CB', 'CD', 'CE', 'CF'"
_BARE = "'01', 'D0', 'D1', 'D2', 'D3', 'D4', 'D5', 'D6', 'D7', 'D8'"
_LAST = "'D9', 'DA'"


def _number(at: str, size: int) -> str:
    """A big-endian number at a byte counted from 1."""
    return f"cast(conv(hex(substring(content, {at}, {size})), 16, 10) as int)"


def _little(at: int) -> str:
    return f"({_number(str(at), 1)} + 256 * {_number(str(at + 1), 1)})"


def _size(width: str, height: str) -> str:
    return f"cast(struct({width}, {height}) as {_SIZE})"


def _jpeg() -> str:
    """Walk over the segments until one holds the size.

    ``at`` is the byte of the next marker, 0 once the walk is over. There are at most half as many
    steps as bytes; two nested loops take them without an array of that length, and the inner
    one is not entered once the walk is over.
    """
    start = f"named_struct('at', 3, 'size', cast(null as {_SIZE}))"
    code = "hex(substring(content, s.at + 1, 1))"

    def state(at: str, size: str = f"cast(null as {_SIZE})") -> str:
        return f"named_struct('at', {at}, 'size', {size})"

    step = f"""CASE WHEN s.at = 0 THEN s
      WHEN s.at + 1 > length(content) OR hex(substring(content, s.at, 1)) <> 'FF' THEN {state('0')}
      WHEN {code} = 'FF' THEN {state('s.at + 1')}
      WHEN {code} IN ({_BARE}) THEN {state('s.at + 2')}
      WHEN {code} IN ({_LAST}) OR s.at + 3 > length(content) THEN {state('0')}
      WHEN {code} IN ({_FRAMES}) THEN
        {state('0', f"CASE WHEN s.at + 8 <= length(content) THEN {_size(_number('s.at + 7', 2), _number('s.at + 5', 2))} END")}
      WHEN {_number('s.at + 2', 2)} < 2 THEN {state('0')}
      ELSE {state(f"s.at + 2 + {_number('s.at + 2', 2)}")} END"""
    steps = "sequence(1, cast(ceil(sqrt(length(content) / 2)) as int) + 1)"
    inner = f"CASE WHEN o.at = 0 THEN o ELSE aggregate({steps}, o, (s, j) -> {step}) END"
    return f"aggregate({steps}, {start}, (o, i) -> {inner}).size"


def header_size(content: str = "content") -> Column:
    """Width and height in the header of a PNG, GIF or JPEG file, null where there is none.

    A struct of the size and of ``known``: whether the file begins as one of the three.
    """
    size = f"""CASE
      WHEN left(kind, 16) = '89504E470D0A1A0A' THEN
        CASE WHEN length(content) >= 24 AND substring(kind, 25, 8) = '49484452' THEN {_size(_number('17', 4), _number('21', 4))} END
      WHEN left(kind, 12) IN ('474946383761', '474946383961') THEN
        CASE WHEN length(content) >= 10 THEN {_size(_little(7), _little(9))} END
      WHEN left(kind, 4) = 'FFD8' THEN {_jpeg()} END"""
    known = "left(kind, 16) = '89504E470D0A1A0A' OR left(kind, 12) IN ('474946383761', '474946383961') OR left(kind, 4) = 'FFD8'"
    kind = "hex(substring(content, 1, 16))"
    body = f"named_struct('size', {size}, 'known', {known})"
    return F.expr(f"transform(array({content}), content -> transform(array({kind}), kind -> {body})[0])[0]")


def image_headers(files: DataFrame, url: Column | None = None) -> DataFrame:
    """``image_url``, ``width``, ``height`` and ``reason`` of every row of a ``binaryFile`` table.

    ``reason`` is null for an image whose size was read, so files without a size are rejects and not
    missing. A size of 0 is none. ``url`` turns the file location ``origin`` into the URL it was fetched from.
    """
    read = files.select(F.col("path").alias("origin"), header_size().alias("_header"))
    size = F.when((F.col("_header.size.width") > 0) & (F.col("_header.size.height") > 0), F.col("_header.size"))
    reason = F.when(~F.coalesce("_header.known", F.lit(False)), NOT_AN_IMAGE).when(size.isNull(), TRUNCATED)
    return read.select(
        (F.col("origin") if url is None else url).alias("image_url"),
        size["width"].alias("width"), size["height"].alias("height"), reason.alias("reason"),
    )


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """All files below a folder, for :func:`image_headers`."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def image_sizes(spark: SparkSession, path: str, url: Column | None = None) -> DataFrame:
    """``image_url``, ``width`` and ``height`` of every image below a folder whose size can be read."""
    headers = image_headers(image_files(spark, path), url)
    return headers.where("reason is null").drop("reason")
