"""From fetched pages to article rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pressmark import schemas
from pressmark.functions import html as H
from pressmark.functions.dates import date_text, parse_month_day_year
from pressmark.functions.html import Selector
from pressmark.functions.text import ascii_fold, decode_references, once, or_empty, squeeze_spaces
from pressmark.functions.urls import percent_spaces, resolve, slug
from pressmark.operators.authors import GENERIC, with_account
from pressmark.session import spread, stage
from pressmark.sources.pages import with_fetch_reason

NO_MAIN = "no main section"
NO_DATE = "article does not contain a date"
NO_SLUG = "no slug in url"
NO_IMAGE_SIZE = "no size of an image"


@dataclass(frozen=True)
class Layout:
    """Where a site keeps each field. A field without a selector is always missing.

    Without a date selector the page table's own ``date`` column is used.
    """

    main: Selector
    body: Selector
    title: Selector | None = None
    subhead: Selector | None = None
    author: Selector | None = None
    telephone: Selector | None = None
    role: Selector | None = None
    message_from: Selector | None = None
    message_to: Selector | None = None
    date: Selector | None = None
    category: Selector | None = None
    figure: Selector | None = None
    caption: Selector | None = None


# Where the news site keeps each field.
NEWS_LAYOUT = Layout(
    main=Selector("div", "id", "main"),
    body=Selector("div", "class", "article-body"),
    title=Selector("h1", "id", "title"),
    subhead=Selector("p", "class", "subhead"),
    author=Selector("span", "class", "name"),
    telephone=Selector("span", "class", "tel"),
    role=Selector("span", "class", "role"),
    message_from=Selector("span", "class", "message-from"),
    message_to=Selector("span", "class", "message-to"),
    date=Selector("p", "class", "date"),
    category=Selector("[a-z][a-z0-9]*", "name", "category"),
    figure=Selector("figure", "class", "article-image"),
    caption=Selector("figcaption", "class", "caption"),
)

PLAIN_LAYOUT = Layout(main=Selector("body"), body=Selector("article"), title=Selector("h1"))


def _text(section: Column, selector: Selector | None) -> Column:
    if selector is None:
        return F.lit(None).cast("string")
    return ascii_fold(H.text_of(section, selector))


def categories(page: Column, layout: Layout) -> Column:
    """Category of every category element of the page, order and repeats kept."""
    if layout.category is None:
        return F.array().cast("array<string>")
    return F.array_compact(F.transform(H.open_tags(page, layout.category), lambda t: H.attribute(t, "content")))


def images(section: Column, url: Column, layout: Layout) -> Column:
    """The image of every figure that has one; of a repeated image URL the last stays. Sizes are as declared, also no numbers."""
    if layout.figure is None:
        return F.array().cast(schemas.ARTICLES["images"].dataType)

    def image(figure: Column) -> Column:
        return once(F.get(H.open_tags(figure, Selector("img")), F.lit(0)), lambda tag: found_image(figure, tag))

    def found_image(figure: Column, tag: Column) -> Column:
        caption = H.text_of(figure, layout.caption) if layout.caption else F.lit(None).cast("string")

        def described(source: Column) -> Column:
            return F.struct(
                percent_spaces(resolve(url, source)).alias("image_url"),
                or_empty(ascii_fold(squeeze_spaces(caption))).alias("image_caption"),
                H.attribute(tag, "width").alias("image_width"),
                H.attribute(tag, "height").alias("image_height"),
            )

        return once(H.attribute(tag, "src"), lambda source: F.when(source.isNotNull(), described(source)))

    found = F.array_compact(H.all_inner_html(section, layout.figure, image))
    return last_of_each(found, "image_url")


def last_of_each(items: Column, key: str) -> Column:
    """Of array items with equal keys the last one, in array order. Sorts, so no pairs are formed."""

    def kept(sorted_items: Column) -> Column:
        return F.filter(
            sorted_items,
            lambda item, i: ~F.coalesce(item["key"] == F.get(sorted_items, i + 1)["key"], F.lit(False)),
        )

    keyed = F.transform(items, lambda x, i: F.struct(x[key].alias("key"), i.alias("at"), x.alias("item")))
    by_key = F.array_sort(keyed)
    alone = once(by_key, kept)
    in_order = F.array_sort(F.transform(alone, lambda x: F.struct(x["at"].alias("at"), x["item"].alias("item"))))
    return F.transform(in_order, lambda x: x["item"])


def body_html(section: Column, url: Column) -> Column:
    """HTML of the body element with absolute links and ASCII text; empty when the page has none.

    Masked parts are put back in ASCII and are not changed otherwise.
    """

    def shown(html: Column) -> Column:
        linked = H.map_link_targets(html, lambda target: resolve(url, target))
        return H.map_text(linked, lambda t: ascii_fold(decode_references(t, markup=False)))

    return or_empty(H.map_shown(section, shown, ascii_fold))


def permalink(url: Column, url_slug: Column) -> Column:
    return F.concat(
        F.lit('<p><a href="'), url, F.lit('" title="Permalink to '), url_slug, F.lit('">Source</a></p>')
    )


def extract(
    pages: DataFrame,
    layout: Layout = NEWS_LAYOUT,
    accounts: DataFrame | None = None,
    sizes: DataFrame | None = None,
    carry: Sequence[str] = (),
    keep_hidden: bool = True,
) -> DataFrame:
    """One row per page with all article fields and ``reason``, null for an accepted page.

    ``carry`` names further page columns to keep, such as the order of fetching. Scripts, styles
    and comments stay in the body's HTML if ``keep_hidden``; all other fields are without them.
    """
    day = ["date"] if layout.date is None else []
    fetched = with_fetch_reason(spread(pages))
    cleaned = fetched.select(
        "url", *carry, *day, F.col("reason").alias("_fetch"), slug(F.col("url")).alias("_slug"),
        H.mask_hidden(F.col("html")).alias("_page"),
    )
    sections = cleaned.select("*", H.inner_html(F.col("_page"), layout.main).alias("_masked"))
    sections = sections.select(
        "*", H.without_masked(F.col("_masked")).alias("_main"), H.inner_html(F.col("_masked"), layout.body).alias("_body")
    )
    main, url = F.col("_main"), F.col("url")
    shown = H.without_masked(F.col("_body"))
    found = parse_month_day_year(date_text(H.text_of(main, layout.date))) if layout.date else F.col("date")
    fields = sections.select(
        "url", *carry, "_fetch", "_slug", main.isNotNull().alias("_has_main"),
        found.alias("date"),
        F.coalesce(_text(main, layout.author), F.lit(GENERIC)).alias("_author"),
        _text(main, layout.role).alias("article_author_title"),
        _text(main, layout.telephone).alias("article_author_telephone"),
        categories(F.col("_page"), layout).alias("categories"),
        _text(main, layout.message_from).alias("message_from"),
        _text(main, layout.message_to).alias("message_to"),
        _text(main, layout.title).alias("title"),
        _text(main, layout.subhead).alias("subhead"),
        images(main, url, layout).alias("images"),
        body_html(F.col("_body") if keep_hidden else shown, url).alias("article_body"),
        ascii_fold(H.visible_text(shown)).alias("article_body_no_html"),
    )
    reason = (
        F.when(F.col("_fetch").isNotNull(), F.col("_fetch"))
        .when(~F.col("_has_main"), NO_MAIN)
        .when(F.col("date").isNull(), NO_DATE)
        .when(F.col("_slug").isNull(), NO_SLUG)
    )
    if sizes is not None:
        fields = with_image_sizes(fields, sizes)
        unknown = F.exists("images", lambda i: i["image_width"].isNull() | i["image_height"].isNull())
        reason = reason.when(unknown, NO_IMAGE_SIZE)
    rows = fields.select(
        "*",
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("-"), F.col("_slug"), F.lit(".md")).alias("file_name"),
        permalink(url, F.col("_slug")).alias("source_permalink"),
        reason.alias("reason"),
    )
    rows = with_account(rows, "_author", accounts)
    return rows.select(*schemas.ARTICLES.fieldNames(), *carry, "reason")


# images used more often than this part of all uses are sent to every executor: fewer than as many
_FREQUENT_IMAGES = 100_000


def with_image_sizes(articles: DataFrame, sizes: DataFrame) -> DataFrame:
    """Fill in sizes a page does not declare from ``sizes(image_url, width, height)``.

    Only the image URLs leave the article rows; they are stored, a row a page, so pages are read for them once (exploded at once,
    Spark would look for their images a second time to drop pages without any). Each URL is looked up once. Those in frequent use are sent to every executor, so one on every page is no hot key.
    """
    used = stage(articles.select("url", F.col("images.image_url").alias("image_urls")), "used_images")
    used = used.select("url", F.explode("image_urls").alias("image_url"))
    uses = used.groupBy("image_url").agg(F.count("*").alias("uses"))
    known = stage(uses.join(sizes, "image_url").groupBy("image_url").agg(
        F.max("uses").alias("uses"), F.max(F.struct("width", "height")).alias("size")), "known_images")
    bound = used.count() / _FREQUENT_IMAGES
    frequent, rare = (known.where(c).drop("uses") for c in (F.col("uses") > bound, F.col("uses") <= bound))
    found = used.join(F.broadcast(frequent), "image_url", "left")
    others = found.where(F.col("size").isNull()).drop("size").join(rare, "image_url")
    pairs = found.where(F.col("size").isNotNull()).unionByName(others).groupBy("url").agg(
        F.collect_set(F.struct("image_url", "size")).alias("_sizes")
    )

    def filled(image: Column, known: Column) -> Column:
        size = F.element_at(known, image["image_url"])
        return F.struct(
            image["image_url"].alias("image_url"),
            image["image_caption"].alias("image_caption"),
            F.coalesce(image["image_width"], size["width"].cast("string")).alias("image_width"),
            F.coalesce(image["image_height"], size["height"].cast("string")).alias("image_height"),
        )

    joined = articles.join(pairs, "url", "left")
    all_filled = once(F.map_from_entries("_sizes"), lambda known: F.transform("images", lambda image: filled(image, known)))
    return joined.withColumn("images", all_filled).drop("_sizes")


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNull()).drop("reason")


def rejects(rows: DataFrame) -> DataFrame:
    """URL and reason of every rejected page."""
    return rows.where(F.col("reason").isNotNull()).select("url", "reason")


def reject_counts(rows: DataFrame) -> DataFrame:
    return rejects(rows).groupBy("reason").agg(F.count("*").alias("pages"))


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with equal keys the one with the highest order; any one of those that tie. Nulls are equal to each other, and lowest.

    ``rows`` is read twice: hand in a stored table. Only keys and orders are grouped. The keys that occur
    more than once are joined to the rows, so the rows of all others are neither sorted nor aggregated, nor shuffled
    while Spark's size check lets it broadcast those keys. Beyond that a key that holds much of the table is the side
    of a join that adaptive execution splits. Only rows that tie are aggregated whole, if there are any.
    """
    narrow = rows.groupBy(F.col(key).alias("_key"), F.col(order).alias("_order")).agg(F.count("*").alias("_copies"))
    repeated = narrow.groupBy("_key").agg(
        F.max("_order").alias("_best"), F.sum("_copies").alias("_rows"), F.max_by("_copies", "_order").alias("_at_best")
    ).where("_rows > 1")
    # without any order all rows of a key tie
    repeated = stage(repeated.select("_key", "_best", (F.coalesce("_at_best", "_rows") > 1).alias("_tied")), "repeated")
    found = rows.join(repeated, rows[key].eqNullSafe(repeated["_key"]), "left")
    is_best = F.col(order).eqNullSafe(F.col("_best"))
    kept = found.where(F.col("_tied").isNull() | (is_best & ~F.col("_tied"))).select(*rows.columns)
    if repeated.where("_tied").isEmpty():
        return kept
    tied = found.where(F.col("_tied") & is_best).groupBy("_key").agg(F.first(F.struct(*rows.columns)).alias("_one"))
    return kept.unionByName(tied.select("_one.*"))


def absolute_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every link of each page with its absolute form, those in comments and scripts left out."""
    href = F.explode(
        F.array_compact(
            F.transform(
                H.open_tags(H.without_hidden(F.col(html)), Selector("a")), lambda tag: H.attribute(tag, "href")
            )
        )
    )
    links = pages.select("url", href.alias("href"))
    return links.withColumn("link", resolve(F.col("url"), F.col("href")))
