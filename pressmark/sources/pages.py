"""Fetched pages and whether they are accepted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressmark import constants as K

NOT_FETCHED = "not fetched"
NOT_HTML = "content type not text/html; charset=UTF-8"


def with_fetch_reason(pages: DataFrame) -> DataFrame:
    """Add ``reason``: null for an accepted page, else why it is rejected.

    The status code and the content type are tested when the table has them.
    """
    reason = F.when(F.col("html").isNull(), NOT_FETCHED)
    if "status_code" in pages.columns:
        failed = F.col("status_code").isNull() | (F.col("status_code") != 200)
        reason = F.when(failed, F.concat(F.lit("status "), F.coalesce(F.col("status_code").cast("string"), F.lit("unknown"))))
        reason = reason.when(F.col("html").isNull(), NOT_FETCHED)
    if "content_type" in pages.columns:
        other = F.col("content_type").isNull() | (F.col("content_type") != K.ACCEPTED_CONTENT_TYPE)
        reason = reason.when(other, NOT_HTML)
    return pages.withColumn("reason", reason)
