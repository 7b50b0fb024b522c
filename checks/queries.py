"""Every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks import tables as T
from pressmark.functions import dates, html as H, text, urls
from pressmark.functions.html import Selector
from pressmark.operators import articles as A, authors, classify, folds, labels, metrics, tfidf
from pressmark.operators.articles import NEWS_LAYOUT, PLAIN_LAYOUT
from pressmark.plans.import_job import ImportJob
from pressmark.session import shared_dir, stage
from pressmark.sinks import render, writers
from pressmark.sources import archive, corpus, pages as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER_MONTHS = archive.month_range("06/1996", "03/1999")
PAGE_MONTHS = archive.month_range("02/1995", "06/1995")
SHARD_LIMIT = 40_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def joined(items: Column, separator: str = "|") -> Column:
    return F.array_join(items, separator)


@query
def article_rows(spark: SparkSession, folder: str) -> DataFrame:
    source = T.pages(spark, folder).withColumn("url", urls.without_query(F.col("url")))
    rows = A.extract(source, PLAIN_LAYOUT, carry=["page_id"])
    fields = ["url", "file_name", "title", "author", "article_body_no_html"]
    stored = stage(A.accepted(rows).select(*fields, "page_id"), "rows")
    return A.last_per_key(stored, "url", "page_id").select(*fields)


@query
def article_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = A.accepted(A.extract(T.news_pages(spark, folder), NEWS_LAYOUT))
    rows = rows.withColumns({"categories": joined(F.col("categories")), "date": F.col("date").cast("string")})
    return rows.drop("images")


@query
def article_images(spark: SparkSession, folder: str) -> DataFrame:
    rows = A.accepted(A.extract(T.news_pages(spark, folder), NEWS_LAYOUT))
    return rows.select("url", F.inline("images"))


@query
def image_sizes_filled(spark: SparkSession, folder: str) -> DataFrame:
    # every page shows the logo; parts stand in for the images of the pages
    logo = '<figure class="article-image"><img src="/logo.png" height="1em"></figure><div class="article-body">'
    pages = T.news_pages(spark, folder)
    pages = pages.withColumn("html", F.replace("html", F.lit('<div class="article-body">'), F.lit(logo)))
    parts = T.table(spark, folder, "part")
    image = F.concat(F.lit(f"{T.SITE}/"), F.date_format(T.day_of("p_partkey"), "yyyy"), F.lit("/b%20"), "p_partkey", F.lit(".png"))
    sizes = parts.select(image.alias("image_url"), F.col("p_size").alias("width"), (F.col("p_size") + 1).alias("height"))
    logos = parts.groupBy(F.lit(f"{T.SITE}/logo.png").alias("image_url")).agg(
        F.max("p_size").alias("width"), F.max("p_size").alias("height"))
    rows = A.accepted(A.extract(pages, NEWS_LAYOUT, sizes=sizes.unionByName(logos)))
    return rows.select("url", F.inline("images")).drop("image_caption")


@query
def reject_report(spark: SparkSession, folder: str) -> DataFrame:
    return A.reject_counts(A.extract(T.news_pages(spark, folder), NEWS_LAYOUT))


@query
def page_accept(spark: SparkSession, folder: str) -> DataFrame:
    fetched = T.table(spark, folder, "pages").select(
        "url", "html",
        F.when(F.col("page_id") % 9 == 4, 404).otherwise(200).alias("status_code"),
        F.when(F.col("page_id") % 7 == 3, "text/html").otherwise("text/html; charset=UTF-8").alias("content_type"),
    )
    return P.with_fetch_reason(fetched).select("url", "reason")


@query
def month_archives(spark: SparkSession, folder: str) -> DataFrame:
    span = T.table(spark, folder, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z"))
    month = F.explode(archive.months(F.col("a").cast("date"), F.col("z").cast("date"))).alias("month")
    return span.select(month).select(F.col("month").cast("string").alias("month"), archive.archive_url(T.SITE, F.col("month")).alias("archive_url"))


@query
def month_range_scan(spark: SparkSession, folder: str) -> DataFrame:
    scanned = T.table(spark, folder, "orders").where(archive.in_months(F.col("o_orderdate"), *ORDER_MONTHS))
    month = F.date_format("o_orderdate", "yyyy/MM").alias("month")
    return scanned.groupBy(month).agg(F.count("*").alias("orders"))


@query
def archive_links(spark: SparkSession, folder: str) -> DataFrame:
    return archive.archive_links(T.table(spark, folder, "pages"), Selector("ul"))


@query
def site_links(spark: SparkSession, folder: str) -> DataFrame:
    return archive.site_links(T.site_pages(spark, folder), archive.month_archives(spark, T.SITE, *PAGE_MONTHS))


@query
def articles_in_range(spark: SparkSession, folder: str) -> DataFrame:
    job = ImportJob(T.SITE, T.UPLOADS, PLAIN_LAYOUT)
    rows = job.articles(T.site_pages(spark, folder), *PAGE_MONTHS, order="page_id")
    return rows.select("url", "file_name", "title", "article_body_no_html")


@query
def page_headers(spark: SparkSession, folder: str) -> DataFrame:
    html = H.without_hidden(F.col("html"))
    return T.table(spark, folder, "pages").select(
        "page_id",
        text.ascii_fold(H.text_of(html, Selector("h1"))).alias("heading"),
        text.ascii_fold(H.text_of(html, Selector("title"))).alias("title"),
    )


@query
def article_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = A.extract(T.pages(spark, folder), PLAIN_LAYOUT, carry=["page_id"])
    return rows.select("page_id", "article_body", "article_body_no_html")


@query
def absolute_links(spark: SparkSession, folder: str) -> DataFrame:
    return A.absolute_links(T.table(spark, folder, "pages"))


@query
def image_paths(spark: SparkSession, folder: str) -> DataFrame:
    links = A.absolute_links(T.table(spark, folder, "pages"))
    image = urls.percent_spaces(F.replace(F.col("link"), F.lit("e"), F.lit(" ")))
    return links.select("url", image.alias("image_url")).select(
        "url", "image_url", urls.media_file_name(F.col("image_url")).alias("file")
    )


@query
def author_account(spark: SparkSession, folder: str) -> DataFrame:
    accounts = T.table(spark, folder, "nation").select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("alias"), F.col("n_name").alias("account")
    )
    unknown = F.when(F.col("doc_id") % 3 == 0, F.lit(" jr")).otherwise(F.lit(""))
    named = T.table(spark, folder, "documents").select("doc_id", F.upper(F.concat("source", unknown)).alias("name"))
    return authors.with_account(named, "name", accounts)


@query
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate")
    full = F.date_format(day, "MMMM d, yyyy")
    written = F.array(
        F.concat(F.lit("Posted "), full, F.lit(" by us")),
        F.lower(F.replace(full, F.lit(" "), F.lit("  "))),
        F.date_format(day, "MMM d, yyyy"),
        F.date_format(day, "MMMMd, yyyy"),
        F.date_format(day, "'Smarch' d, yyyy"),
        F.date_format(day, "MMMM dd, yyyy"),
    )
    shape = (F.col("o_orderkey") % 6).cast("int")
    dated = T.table(spark, folder, "orders").select("o_orderkey", F.get(written, shape).alias("written"))
    day = dates.parse_month_day_year(dates.date_text(F.col("written")))
    return dated.select("o_orderkey", day.cast("string").alias("day"))


@query
def date_formats(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return T.table(spark, folder, "orders").select(
        "o_orderkey", dates.upload_folder(day).alias("folder"), dates.rfc2822(day).alias("rfc2822"),
        dates.midnight_text(day).alias("midnight"),
    )


@query
def dedupe_url(spark: SparkSession, folder: str) -> DataFrame:
    keyed = T.table(spark, folder, "pages").select(urls.slug(F.col("url")).alias("slug"), "page_id", "url")
    return A.last_per_key(keyed, "slug", "page_id")


@query
def object_ids(spark: SparkSession, folder: str) -> DataFrame:
    ids = joined(F.transform("images", lambda i: i["image_id"].cast("string")), ",")
    return T.numbered_articles(spark, folder).select("url", "post_id", ids.alias("image_ids"))


@query
def import_shards(spark: SparkSession, folder: str) -> DataFrame:
    items = writers.import_items(T.numbered_articles(spark, folder), T.UPLOADS)
    return writers.shard_sizes(writers.import_shards(items, SHARD_LIMIT))


@query
def import_files(spark: SparkSession, folder: str) -> DataFrame:
    items = writers.import_items(T.numbered_articles(spark, folder), T.UPLOADS)
    return writers.import_files(items, SHARD_LIMIT).select("file_name", "content")


@query
def render_items(spark: SparkSession, folder: str) -> DataFrame:
    return T.numbered_articles(spark, folder).select("url", render.post_item(T.UPLOADS).alias("item"))


@query
def render_attachments(spark: SparkSession, folder: str) -> DataFrame:
    return T.numbered_articles(spark, folder).select("url", render.attachment_items(T.UPLOADS).alias("items"))


@query
def render_captions(spark: SparkSession, folder: str) -> DataFrame:
    return T.numbered_articles(spark, folder).select("url", render.captions(T.UPLOADS).alias("captions"))


@query
def render_markdown(spark: SparkSession, folder: str) -> DataFrame:
    return writers.markdown_files(T.numbered_articles(spark, folder), T.UPLOADS)


@query
def render_news_items(spark: SparkSession, folder: str) -> DataFrame:
    return T.numbered_news(spark, folder).select("url", render.import_item(T.UPLOADS).alias("item"))


@query
def render_news_markdown(spark: SparkSession, folder: str) -> DataFrame:
    return writers.markdown_files(T.numbered_news(spark, folder), T.UPLOADS)


@query
def import_news_files(spark: SparkSession, folder: str) -> DataFrame:
    items = writers.import_items(T.numbered_news(spark, folder), T.UPLOADS)
    return writers.import_files(items, SHARD_LIMIT).select("file_name", "content")


@query
def corpus_render(spark: SparkSession, folder: str) -> DataFrame:
    content = render.training_document(F.col("categories"), F.col("text"))
    return T.labelled_documents(spark, folder).select("doc_id", content.alias("content"))


@query
def corpus_parse(spark: SparkSession, folder: str) -> DataFrame:
    shown = F.concat(F.array(F.lit("Home Page")), F.col("categories"), F.array(F.lit("Regular News")))
    written = T.labelled_documents(spark, folder).select(
        "doc_id", render.training_document(shown, F.col("text")).alias("content")
    )
    return corpus.parse_training(written).withColumn("categories", joined(F.col("categories")))


@query
def front_matter_parse(spark: SparkSession, folder: str) -> DataFrame:
    content = F.concat(F.lit("---\nurl: "), F.col("url"), F.lit("\n---\n"), F.col("html"), F.lit("\n---\nend\n"))
    return corpus.parse_front_matter(T.table(spark, folder, "pages").select("page_id", content.alias("content")))


@query
def render_categorised(spark: SparkSession, folder: str) -> DataFrame:
    metadata = F.concat(F.lit("id: "), F.col("doc_id").cast("string"), F.lit("\n"))
    content = render.categorised_document(metadata, F.col("categories"), F.col("text"))
    return T.labelled_documents(spark, folder).select("doc_id", content.alias("content"))


@query
def training_from_articles(spark: SparkSession, folder: str) -> DataFrame:
    rows = A.accepted(A.extract(T.pages(spark, folder), PLAIN_LAYOUT))
    rows = rows.withColumn("categories", F.array("author", "title"))
    kept = corpus.training_from_articles(rows)
    return kept.withColumn("categories", joined(F.col("categories")))


@query
def label_filter(spark: SparkSession, folder: str) -> DataFrame:
    kept = corpus.drop_labels(F.array("lang", "source"), ["fr", "src3"])
    return T.table(spark, folder, "documents").select("doc_id", joined(kept).alias("categories"))


@query
def label_filter_counts(spark: SparkSession, folder: str) -> DataFrame:
    sources = [f"src{i}" for i in range(20)]
    kept = corpus.drop_labels(F.col("categories"), ["en", "fr", *sources])
    return corpus.label_counts(T.labelled_documents(spark, folder).withColumn("categories", kept))


@query
def label_vocab(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_vocabulary(T.labelled_documents(spark, folder))


@query
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    documents = T.labelled_documents(spark, folder)
    return labels.encode_labels(documents, labels.label_vocabulary(documents))


@query
def label_decode(spark: SparkSession, folder: str) -> DataFrame:
    documents = T.labelled_documents(spark, folder)
    vocabulary = labels.label_vocabulary(documents)
    decoded = labels.decode_labels(labels.encode_labels(documents, vocabulary), vocabulary)
    return decoded.withColumn("categories", joined(F.col("categories")))


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    documents, marked = T.table(spark, folder, "documents"), T.table(spark, folder, "labels")
    both = marked.join(documents.select("doc_id", "n_chars"), "doc_id")
    truth = marked.select("doc_id", F.explode(F.create_map(
        F.lit("quality"), "quality", F.lit("toxic"), "toxic")).alias("label", "value")).where("value = 1")
    scores = both.select("doc_id", F.explode(F.create_map(
        F.lit("quality"), F.col("n_chars") / 2000, F.lit("toxic"), F.lit(500) / F.col("n_chars"))).alias("label", "score"))
    every = truth.select("label").distinct().unionByName(
        documents.select(F.concat(F.lit("unused "), "lang").alias("label")).distinct())
    return metrics.confusion(truth, metrics.positives(scores, 1.0), every, marked)


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query
def confusion_by_label(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_matrix(spark, folder))


@query
def confusion_totals(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.totals(_matrix(spark, folder))


@query
def metrics_macro(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.macro(_matrix(spark, folder)))


@query
def metrics_micro(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.micro(_matrix(spark, folder)))


@query
def kfold_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return folds.fold_sizes(T.table(spark, folder, "documents"), 7)


@query
def kfold_assign(spark: SparkSession, folder: str) -> DataFrame:
    return folds.assign_folds(T.table(spark, folder, "documents"), 7)


@query
def shuffled_folds(spark: SparkSession, folder: str) -> DataFrame:
    return folds.assign_folds(T.table(spark, folder, "documents"), 7, seed=42)


@query
def kfold_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = folds.assign_folds(T.table(spark, folder, "documents"), 7)
    tested = folds.held_out_rows(rows, 2).select("doc_id", F.lit("test").alias("part"))
    return tested.unionByName(folds.training_rows(rows, 2).select("doc_id", F.lit("train").alias("part")))


@query
def tfidf_terms(spark: SparkSession, folder: str) -> DataFrame:
    documents = T.table(spark, folder, "documents")
    counts = tfidf.by_term(tfidf.term_counts(documents), tfidf.parts(documents))
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


@query
def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    return tfidf.tfidf(T.table(spark, folder, "documents")).withColumn("weight", F.round("weight", 6))


@query
def classify_documents(spark: SparkSession, folder: str) -> DataFrame:
    model = classify.fit(T.labelled_documents(spark, folder), "text")
    predicted = model.predict(T.unlabelled_documents(spark, folder), "text", ["doc_id"])
    return predicted.withColumn("categories", joined(F.col("categories")))


def _saved_model(spark: SparkSession, folder: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    classify.save_tables(*T.given_model(spark, folder), path)
    return path


@query
def score_with_model(spark: SparkSession, folder: str) -> DataFrame:
    """A saved model is loaded into memory and sent to the tasks; a larger one stays in its tables."""
    model = classify.load_stored(spark, _saved_model(spark, folder))
    rows = classify.with_terms(T.unlabelled_documents(spark, folder), "text")
    scores = F.posexplode("scores").alias("label_id", "score")
    names = F.array(*[F.lit(category) for _, category, _ in model.index])
    return model.scores(rows, ["doc_id"]).select("doc_id", scores).select(
        "doc_id", F.get(names, F.col("label_id")).alias("category"), F.round("score", 6).alias("score"))


@query
def score_by_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The same by joins with the saved tables."""
    scored = classify.score_by_tables(T.unlabelled_documents(spark, folder), _saved_model(spark, folder))
    return scored.withColumn("score", F.round("score", 6))


@query
def classify_planted(spark: SparkSession, folder: str) -> DataFrame:
    """Learnt from the labelled documents, saved, loaded and applied to all others."""
    documents = T.planted_documents(spark, folder)
    marked = T.table(spark, folder, "labels").select("doc_id").distinct()
    path = f"{shared_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    classify.load_or_fit(documents.join(marked, "doc_id", "left_semi"), path, "text")
    predicted = classify.load(spark, path).predict(documents.join(marked, "doc_id", "left_anti"), "text", ["doc_id"])
    return predicted.withColumn("categories", joined(F.col("categories")))


@query
def kfold_planted(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(classify.cross_validate(T.planted_documents(spark, folder), 3, seed=42))


@query
def kfold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(classify.cross_validate(T.labelled_documents(spark, folder), 3, seed=42))


@query
def url_slug(spark: SparkSession, folder: str) -> DataFrame:
    return T.table(spark, folder, "pages").select("url", urls.slug(F.col("url")).alias("slug"))


@query
def url_ending(spark: SparkSession, folder: str) -> DataFrame:
    return T.table(spark, folder, "pages").select("url", urls.ending(F.col("url")).alias("ending"))


@query
def nicename(spark: SparkSession, folder: str) -> DataFrame:
    names = T.table(spark, folder, "part").select(F.col("p_type").alias("name"))
    names = names.unionByName(T.table(spark, folder, "nation").select(F.col("n_name").alias("name"))).distinct()
    return names.select("name", text.nicename(F.col("name")).alias("nicename"))


@query
def cp1252_repair(spark: SparkSession, folder: str) -> DataFrame:
    spoilt = F.translate("text", "aeiou", "\x80\x93\x94\x99\x96")
    return T.table(spark, folder, "documents").select("doc_id", text.repair_cp1252(spoilt).alias("text"))


@query
def ascii_fold(spark: SparkSession, folder: str) -> DataFrame:
    return T.table(spark, folder, "documents").select("doc_id", text.ascii_fold(F.col("text")).alias("text"))


@query
def strip_tags(spark: SparkSession, folder: str) -> DataFrame:
    return T.table(spark, folder, "pages").select("page_id", H.strip_tags(F.col("html")).alias("text"))


@query
def squeeze_spaces(spark: SparkSession, folder: str) -> DataFrame:
    return T.table(spark, folder, "documents").select("doc_id", text.squeeze_spaces(F.col("text")).alias("text"))


@query
def tokenise(spark: SparkSession, folder: str) -> DataFrame:
    return T.table(spark, folder, "documents").select("doc_id", joined(text.tokens(F.col("text"))).alias("tokens"))


@query
def word_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    grams = text.word_ngrams(text.tokens(F.col("text")))
    return T.table(spark, folder, "documents").select("doc_id", joined(grams).alias("terms"))
