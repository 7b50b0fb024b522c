"""Month archives and the links they hold."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmark import constants as K
from pressmark.functions.dates import month_of, upload_folder
from pressmark.functions.html import Selector, all_inner_html, attribute, open_tags, without_hidden
from pressmark.sources.pages import with_fetch_reason

ARCHIVE_LIST = Selector("ul", "class", "archive-list")


def month_range(
    start: str | None = None, end: str | None = None, today: datetime.date | None = None
) -> tuple[datetime.date, datetime.date]:
    """First days of the first and last month of two ``mm/yyyy`` arguments.

    Defaults are the archive's first month and the current one.
    """
    today = today or datetime.date.today()
    start_month, start_year = month_of(start or K.FIRST_MONTH)
    end_month, end_year = month_of(end) if end else (today.month, today.year)
    first = datetime.date(start_year, start_month, 1)
    last = datetime.date(end_year, end_month, 1)
    if first > last:
        raise ValueError(f"start month {first:%m/%Y} is after end month {last:%m/%Y}")
    return first, last


def open_end(end_month: int | None, end_year: int | None, today: datetime.date | None = None) -> str:
    """The ``mm/yyyy`` end of a range left open: this year, and December unless it is this year."""
    today = today or datetime.date.today()
    year = end_year or today.year
    month = end_month or (12 if year < today.year else today.month)
    return f"{month:02d}/{year:04d}"


def months(first: Column, last: Column) -> Column:
    """Every first of a month from one to the other."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def archive_url(site: str | Column, month: Column) -> Column:
    site = F.lit(site) if isinstance(site, str) else site
    return F.concat(F.rtrim(site, F.lit("/")), F.lit("/"), upload_folder(month))


def month_archives(spark: SparkSession, site: str, first: datetime.date, last: datetime.date) -> DataFrame:
    """One archive location per month of the range."""
    month = F.explode(months(F.lit(first), F.lit(last))).alias("month")
    return spark.range(1).select(month).select("month", archive_url(site, F.col("month")).alias("archive_url"))


def in_months(day: Column, first: datetime.date, last: datetime.date) -> Column:
    """Whether a day lies in the month range; a plain comparison, so it reaches the scan."""
    return (day >= F.lit(first)) & (day < F.lit(month_after(last)))


def month_after(month: datetime.date) -> datetime.date:
    return (month.replace(day=28) + datetime.timedelta(days=4)).replace(day=1)


def below_archives(url: Column, site: str, first: datetime.date, last: datetime.date) -> Column:
    """Whether a URL is a month archive of the range or begins with one, as all links of archives do.

    Month archives are in order as texts, so this is a plain comparison that reaches the scan.
    """
    return (url >= archive_url(site, F.lit(first))) & (url < archive_url(site, F.lit(month_after(last))))


def archive_links(pages: DataFrame, archive_list: Selector = ARCHIVE_LIST) -> DataFrame:
    """Distinct links of each accepted archive page: its URL followed by the link text as it stands.

    ``pages`` has ``url`` and ``html``. Links without a target are skipped.
    """
    accepted = with_fetch_reason(pages).where(F.col("reason").isNull())
    tags = F.flatten(
        all_inner_html(without_hidden(F.col("html")), archive_list, lambda block: open_tags(block, Selector("a")))
    )
    hrefs = F.array_distinct(F.array_compact(F.transform(tags, lambda tag: attribute(tag, "href"))))
    return (
        accepted.select(F.col("url").alias("archive_url"), F.explode(hrefs).alias("href"))
        .select("archive_url", F.concat("archive_url", "href").alias("article_url"))
        .distinct()
    )


def site_links(pages: DataFrame, archives: DataFrame, archive_list: Selector = ARCHIVE_LIST) -> DataFrame:
    """Links of all archive pages of a month range, in one pass over the page table."""
    wanted = pages.join(archives.select(F.col("archive_url").alias("url")), "url", "left_semi")
    return archive_links(wanted, archive_list)
