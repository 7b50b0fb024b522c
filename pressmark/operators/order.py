"""Positions and ids in a global order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressmark.session import stage


def with_position(rows: DataFrame, *keys: str | Column, weight: str | None = None) -> DataFrame:
    """Add ``position``, the dense 0-based rank of each row by the unique ``keys``.

    With ``weight`` also ``before``, the sum of the weights of all earlier rows. Rows are
    range-partitioned, sorted and staged, so every row has a fixed slot: its range and its
    place there. Only one total per range is then put in sequence. Pass narrow rows: all
    columns go through the shuffle.
    """
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    staged = stage(ordered.withColumn("_slot", F.monotonically_increasing_id()), "order")
    # the slot is the partition in the upper 31 bits and the row within it in the lower 33
    slotted = staged.withColumn("_range", F.shiftright("_slot", 33))
    total = F.sum(weight) if weight else F.count("*")
    sizes = slotted.groupBy("_range").agg(F.count("*").alias("_rows"), total.alias("_weight"))
    # one row per range partition, never more than spark.sql.shuffle.partitions rows
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"),
        F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_first_weight"),
    )
    placed = slotted.join(F.broadcast(starts), "_range")
    placed = placed.withColumn("position", F.col("_first") + F.col("_slot") - F.shiftleft("_range", 33))
    if weight:
        within = Window.partitionBy("_range").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn(
            "before", F.col("_first_weight") + F.coalesce(F.sum(weight).over(within), F.lit(0))
        )
    return placed.drop("_slot", "_range", "_first", "_first_weight")


def assign_ids(articles: DataFrame, start_index: int = 0, key: str = "url") -> DataFrame:
    """Number images and posts: an article's images first, then its post; the first id follows the start.

    Adds ``position``, ``post_id`` and ``image_id`` within ``images``. Ids are dense. ``articles``
    is read twice, so pass a stored table.
    """
    counted = articles.select(key, (F.coalesce(F.size("images"), F.lit(0)) + 1).cast("long").alias("_objects"))
    counted = with_position(counted, key, weight="_objects")
    joined = articles.join(counted, key)
    first = F.col("before") + F.lit(start_index + 1)
    return joined.withColumns(
        {
            "post_id": F.lit(start_index) + F.col("before") + F.col("_objects"),
            "images": F.transform("images", lambda image, i: image.withField("image_id", first + i)),
        }
    ).drop("before", "_objects")
