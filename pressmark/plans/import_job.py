"""From archive months to import files."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from pressmark import constants as K
from pressmark.operators.articles import NEWS_LAYOUT, Layout, accepted, extract, last_per_key, rejects
from pressmark.operators.order import assign_ids
from pressmark.session import job, stage
from pressmark.sinks import writers
from pressmark.sources.archive import ARCHIVE_LIST, below_archives, month_archives, site_links


@dataclass(frozen=True)
class ImportJob:
    """``site`` is the archive's address, ``upload_root`` the one media will be served from."""

    site: str
    upload_root: str
    layout: Layout = NEWS_LAYOUT
    accounts: DataFrame | None = None
    sizes: DataFrame | None = None
    zone: str = "UTC"
    limit: int = K.IMPORT_FILE_LIMIT

    def rows(self, pages: DataFrame, first: datetime.date, last: datetime.date, order: str) -> DataFrame:
        """Article rows, accepted or not, of all links in the archives of a month range.

        ``pages`` holds archive and article pages; ``order`` is its column of fetching order.
        Links are made distinct before any article page is looked at. Both readings of the
        pages skip, in the scan, what cannot be in the months.
        """
        pages = pages.where(below_archives(F.col("url"), self.site, first, last))
        archives = month_archives(pages.sparkSession, self.site, first, last)
        links = site_links(pages, archives, ARCHIVE_LIST).select(F.col("article_url").alias("url")).distinct()
        # stored, so that Spark's size check knows the links and sends them to the pages, whose HTML then stays where it is
        links = stage(links, "links")
        wanted = pages.join(links, "url", "left_semi")
        return extract(wanted, self.layout, self.accounts, self.sizes, carry=[order])

    def articles(self, pages: DataFrame, first: datetime.date, last: datetime.date, order: str) -> DataFrame:
        """One accepted row per URL; of several the one fetched last."""
        rows = stage(accepted(self.rows(pages, first, last, order)), "rows")
        return last_per_key(rows, "url", order).drop(order)

    def run(
        self,
        pages: DataFrame,
        first: datetime.date,
        last: datetime.date,
        order: str,
        target: str,
        start_index: int = 0,
        markdown: bool = False,
        packed: bool = False,
    ) -> None:
        """Write import files, the rejects table and, if wanted, markdown below ``target``.

        ``packed`` keeps many markdown documents a file, else each is a file of its own.
        """
        with job(pages.sparkSession):
            rows = stage(self.rows(pages, first, last, order), "rows")
            kept = stage(last_per_key(accepted(rows), "url", order).drop(order), "articles")
            numbered = stage(assign_ids(kept, start_index), "numbered")
            items = writers.import_items(numbered, self.upload_root, self.zone)
            writers.write_named_texts(writers.import_files(items, self.limit), f"{target}/import")
            writers.write_rejects(rejects(rows), f"{target}/rejects")
            if markdown:
                write = writers.write_packed if packed else writers.write_texts
                write(writers.markdown_files(numbered, self.upload_root), f"{target}/markdown")
