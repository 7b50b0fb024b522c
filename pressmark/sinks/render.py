"""Articles and documents as text: import items, markdown, corpus files."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from pressmark import constants as K
from pressmark.functions.dates import midnight_text, rfc2822, upload_folder
from pressmark.functions.text import nicename, or_empty, single_quotes
from pressmark.functions.urls import ending, media_file_name, slug
from pressmark.sinks import templates as T

_OPTIONAL = (
    "subhead", "article_author", "article_author_title", "article_author_telephone",
    "message_from", "message_to",
)


def fill(template: str, **values: Column) -> Column:
    """A template with each ``{name}`` replaced by a column."""
    parts = re.split(r"\{(\w+)\}", template)
    columns = [values[part] if i % 2 else F.lit(part) for i, part in enumerate(parts) if i % 2 or part]
    return F.concat(*columns)


def escape_markup(text: Column) -> Column:
    for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(reference))
    return text


def in_cdata(text: Column) -> Column:
    """Text that cannot end the CDATA section it stands in."""
    return F.replace(text, F.lit("]]>"), F.lit("]]]]><![CDATA[>"))


def _text_of(number: Column) -> Column:
    return or_empty(number.cast("string"))


def captions(root: str, media_folder: str = "") -> Column:
    """Caption block of every image."""
    folder = F.concat(F.lit(root + media_folder), upload_folder(F.col("date")))

    def block(image: Column) -> Column:
        return fill(
            T.CAPTION,
            image_id=_text_of(image["image_id"]),
            width=_text_of(image["image_width"]),
            height=_text_of(image["image_height"]),
            caption=or_empty(image["image_caption"]),
            path=F.concat(folder, media_file_name(image["image_url"])),
        )

    return F.array_join(F.transform("images", block), "")


def post_item(root: str, zone: str = "UTC") -> Column:
    """Import item of an article."""

    def pair(key: str, value: Column) -> Column:
        return fill(T.POST_METADATA, key=F.lit(key), value=value)

    optional = [
        F.when(
            F.col(name).isNotNull(),
            pair(name, in_cdata(single_quotes(F.col(name)) if name == "subhead" else F.col(name))),
        ).otherwise(F.lit(""))
        for name in _OPTIONAL
    ]
    return fill(
        T.POST_ITEM,
        title=escape_markup(single_quotes(or_empty(F.col("title")))),
        pub_date=rfc2822(F.col("date"), zone),
        post_id=_text_of(F.col("post_id")),
        captions=in_cdata(captions(root, T.MEDIA_FOLDER)),
        body=in_cdata(or_empty(F.col("article_body"))),
        permalink=in_cdata(F.col("source_permalink")),
        author=in_cdata(or_empty(F.col("author"))),
        post_date=midnight_text(F.col("date")),
        slug=slug(F.col("url")),
        categories=F.array_join(
            F.transform(
                "categories",
                lambda c: fill(T.POST_CATEGORY, nicename=escape_markup(nicename(c)), name=in_cdata(c)),
            ),
            "",
        ),
        metadata=F.concat(pair("_edit_last", F.lit("1")), *optional),
    )


def attachment_items(root: str, zone: str = "UTC") -> Column:
    """Import items of the images of an article, one after the other."""
    values = {
        "upload_root": F.lit(root),
        "folder": upload_folder(F.col("date")),
        "ending": ending(F.col("url")),
        "pub_date": rfc2822(F.col("date"), zone),
        "author": in_cdata(or_empty(F.col("author"))),
        "post_date": midnight_text(F.col("date")),
        "post_id": _text_of(F.col("post_id")),
    }

    def item(image: Column) -> Column:
        return fill(
            T.ATTACHMENT_ITEM,
            image_id=_text_of(image["image_id"]),
            image_url=escape_markup(image["image_url"]),
            caption=in_cdata(or_empty(image["image_caption"])),
            file=media_file_name(image["image_url"]),
            **values,
        )

    return F.array_join(F.transform("images", item), "")


def import_item(root: str, zone: str = "UTC") -> Column:
    """An article's part of an import file: its post, then its images."""
    return F.concat(post_item(root, zone), attachment_items(root, zone))


def category_lines(categories: Column) -> Column:
    return F.array_join(
        F.transform(categories, lambda c: fill(T.CATEGORY_LINES, name=c, nicename=nicename(c))), ""
    )


def markdown(root: str) -> Column:
    """An article as markdown with front matter."""
    values = {
        "upload_root": F.lit(root),
        "folder": upload_folder(F.col("date")),
        "ending": ending(F.col("url")),
    }

    def image_lines(image: Column) -> Column:
        return fill(
            T.MARKDOWN_IMAGE,
            image_url=image["image_url"],
            image_id=_text_of(image["image_id"]),
            caption=single_quotes(or_empty(image["image_caption"])),
            file=media_file_name(image["image_url"]),
            **values,
        )

    return fill(
        T.MARKDOWN,
        title=single_quotes(or_empty(F.col("title"))),
        subhead=single_quotes(or_empty(F.col("subhead"))),
        author=or_empty(F.col("author")),
        article_author=or_empty(F.col("article_author")),
        role=or_empty(F.col("article_author_title")),
        telephone=or_empty(F.col("article_author_telephone")),
        message_from=or_empty(F.col("message_from")),
        message_to=or_empty(F.col("message_to")),
        post_id=_text_of(F.col("post_id")),
        categories=category_lines(F.col("categories")),
        images=F.array_join(F.transform("images", image_lines), ""),
        captions=captions(root),
        body=or_empty(F.col("article_body")),
        permalink=F.col("source_permalink"),
    )


def training_document(categories: Column, body: Column) -> Column:
    """A labelled document as corpus text."""
    lines = F.array_join(F.transform(categories, lambda c: F.concat(F.lit("category: "), c, F.lit("\n"))), "")
    return fill(T.TRAINING, marker=F.lit(K.CORPUS_MARKER), categories=lines, body=or_empty(body))


def categorised_document(metadata: Column, categories: Column, body: Column) -> Column:
    """A front-matter document with its predicted categories added."""
    return fill(T.CATEGORISED, metadata=metadata, categories=category_lines(categories), body=body)
