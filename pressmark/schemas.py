"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

IMAGE = T.StructType(
    [
        T.StructField("image_url", T.StringType()),
        T.StructField("image_caption", T.StringType()),
        T.StructField("image_width", T.StringType()),
        T.StructField("image_height", T.StringType()),
    ]
)

ARTICLES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("source_permalink", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("article_author", T.StringType()),
        T.StructField("article_author_title", T.StringType()),
        T.StructField("article_author_telephone", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("message_from", T.StringType()),
        T.StructField("message_to", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("title", T.StringType()),
        T.StructField("subhead", T.StringType()),
        T.StructField("images", T.ArrayType(IMAGE)),
        T.StructField("article_body", T.StringType()),
        T.StructField("article_body_no_html", T.StringType()),
    ]
)

ACCOUNTS = T.StructType(
    [T.StructField("alias", T.StringType()), T.StructField("account", T.StringType())]
)
