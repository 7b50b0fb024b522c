"""Article rows from pages as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pressmark.operators.articles import NEWS_LAYOUT, Layout, extract


def write_rows(pages: DataFrame, target: str, checkpoint: str, layout: Layout = NEWS_LAYOUT) -> StreamingQuery:
    """Append the rows of every new page, accepted or not, to a parquet folder and stop when all are done."""
    return (
        extract(pages, layout)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
