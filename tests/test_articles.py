from __future__ import annotations

import datetime
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from pressmark.functions import html as H
from pressmark.operators import articles as A, authors
from pressmark.operators.articles import NEWS_LAYOUT
from pressmark.sources import archive, images, pages

PAGE = """<html><head><meta name="category" content="News &amp; Views"><meta content='B' name=category>
<meta name="category"><script>var x="<div id='main'>"</script></head><body><!-- <div id="main"> -->
<div id="main"><h1 id="title">Café “X”</h1><p class="subhead">Sub<p class="date">{date}</p>
<span class="name">{name}</span><span class="tel">555</span><span class="message-from">Dean</span>
<figure class="article-image big"><img src="/i/a b.jpg" width="20"><figcaption class="caption"> a
 caption… </figcaption></figure><figure class="article-image">none</figure>
<figure class="article-image"><img src="../z.png" width=5 height="6"/></figure>
<figure class="article-image"><img src="/i/a b.jpg" width=30></figure><figure><img src="/not.png"></figure>
<div class="article-body"><p>Téxt &amp; <a href="/x">l</a></p><div>in</div></div></div></body></html>"""
MARCH = "March 3, 2011"


@pytest.fixture(scope="module")
def rows(spark):
    made = {
        "http://h.com/2011/03/full.html": PAGE.format(date=MARCH, name="Dan White"),
        "http://h.com/2011/03/other.html": PAGE.format(date=MARCH, name="Jane Roe"),
        "http://h.com/2011/03/bad.html": PAGE.format(date="Smarch 3, 2011", name="x"),
        "http://h.com/2011/03/none.html": PAGE.replace("date\">", "day\">").format(date=MARCH, name="x"),
        "http://h.com/2011/03/bare.html": f'<div id="main"><p class="date">{MARCH}</p></div>',
        "http://h.com/2011/03/nomain.html": "<p>no",
        "noslug": f'<div id="main"><p class="date">{MARCH}</p></div>',
        "http://h.com/2011/03/lost.html": None,
    }
    frame = spark.createDataFrame(list(made.items()), "url string, html string")
    return {r["url"].rsplit("/", 1)[-1]: r for r in A.extract(frame, NEWS_LAYOUT).collect()}


def test_full_page(rows):
    row = rows["full.html"].asDict(recursive=True)
    assert row["reason"] is None
    assert row["date"] == datetime.date(2011, 3, 3)
    assert row["file_name"] == "2011-03-03-full.md"
    assert row["title"] == 'Cafe "X"' and row["subhead"] == "Sub"
    assert (row["author"], row["article_author"]) == ("Daniel White", None)
    assert row["article_author_telephone"] == "555" and row["article_author_title"] is None
    assert (row["message_from"], row["message_to"]) == ("Dean", None)
    assert row["categories"] == ["News & Views", "B"]
    assert row["article_body"] == '<p>Text &amp; <a href="http://h.com/x">l</a></p><div>in</div>'
    assert row["article_body_no_html"] == "Text & lin"
    assert row["source_permalink"] == (
        '<p><a href="http://h.com/2011/03/full.html" title="Permalink to full">Source</a></p>'
    )


def test_images(rows):
    found = [tuple(i) for i in rows["full.html"]["images"]]
    assert found == [
        ("http://h.com/2011/z.png", "", "5", "6"),
        ("http://h.com/i/a%20b.jpg", "", "30", None),
    ]


def test_unknown_and_missing_author(rows):
    assert (rows["other.html"]["author"], rows["other.html"]["article_author"]) == (A.GENERIC, "Jane Roe")
    assert (rows["bare.html"]["author"], rows["bare.html"]["article_author"]) == (A.GENERIC, None)


def test_missing_body(rows):
    assert rows["bare.html"]["article_body"] == "" and rows["bare.html"]["article_body_no_html"] is None
    assert rows["bare.html"]["images"] == [] and rows["bare.html"]["title"] is None


def test_reasons(rows):
    found = {name: row["reason"] for name, row in rows.items() if row["reason"]}
    assert found == {
        "bad.html": A.NO_DATE, "none.html": A.NO_DATE, "nomain.html": A.NO_MAIN, "noslug": A.NO_SLUG,
        "lost.html": pages.NOT_FETCHED,
    }


def test_fetch_reasons(spark):
    made = [("a", "x", 200, "text/html; charset=UTF-8"), ("b", "x", 404, "text/html; charset=UTF-8"),
            ("c", "x", 200, "text/html"), ("d", None, 200, None), ("e", "x", None, None)]
    frame = spark.createDataFrame(made, "url string, html string, status_code int, content_type string")
    found = {r["url"]: r["reason"] for r in pages.with_fetch_reason(frame).collect()}
    assert found == {"a": None, "b": "status 404", "c": pages.NOT_HTML, "d": pages.NOT_FETCHED, "e": "status unknown"}


def test_last_accepted_row_wins(spark):
    made = [("u", 1, None), ("u", 2, None), ("u", 3, "broken"), ("v", 4, None)]
    frame = spark.createDataFrame(made, "url string, n int, reason string")
    kept = A.last_per_key(A.accepted(frame), "url", "n").collect()
    assert {(r["url"], r["n"]) for r in kept} == {("u", 2), ("v", 4)}
    assert [r["url"] for r in A.rejects(frame).collect()] == ["u"]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_last_per_key(spark, broadcast):
    made = [(f"k{i % 40}" if i % 3 else "hot", i, f"body {i}") for i in range(600)]
    made += [(None, 1, "x"), (None, 2, "y"), ("unordered", None, "x"), ("unordered", None, "y"), ("half", None, "x"), ("half", -5, "y")]
    wanted = {}
    for key, n, body in made:
        wanted[key] = max(wanted.get(key, (-1000, "")), (-1000 if n is None else n, body))
    frame = spark.createDataFrame(made, "url string, n int, body string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        apart = A.last_per_key(frame.where("url is null or url <> 'unordered'"), "url", "n")
        assert "SortAggregate" not in apart._jdf.queryExecution().executedPlan().toString()
        assert {r["url"]: (r["n"], r["body"]) for r in apart.collect()} == {k: v for k, v in wanted.items() if k != "unordered"}
        twice = A.last_per_key(frame.unionByName(frame), "url", "n").collect()
        assert len(twice) == len(wanted) and twice[0].__fields__ == ["url", "n", "body"]
        assert {r["url"]: r["body"] for r in twice if r["url"] != "unordered"} == {k: b for k, (_, b) in wanted.items() if k != "unordered"}
        assert A.last_per_key(frame.limit(0), "url", "n").collect() == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_accounts_table(spark):
    accounts = spark.createDataFrame([("jane roe", "Jane")], "alias string, account string")
    frame = spark.createDataFrame([("Jane ROE",), ("Bob",), (None,)], "name string")
    found = authors.with_account(frame, "name", accounts).collect()
    assert {(r["author"], r["article_author"]) for r in found} == {
        ("Jane", None), (A.GENERIC, "Bob"), (A.GENERIC, None)
    }


def png(width: int, height: int) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    lines = b"".join(b"\0" + b"\0\0\0" * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


NESTED = """<div id="main"><p class="date">March 3, 2011</p>
<figure class="article-image"><figure class="article-image"><img src="/in.png" width="100%"></figure>
<figcaption class="caption">out</figcaption></figure><figure class="article-image"><img src="/open.png">
<div class="article-body"><p>h\xe9</p><script src="w.js">"</div>\xe9&eacute;"</script><!-- </div><a href="c"> --><style>p {}</style><a href="d">e</a></div></div>"""


def test_body_keeps_hidden_parts_and_figures_nest(spark):
    frame = spark.createDataFrame([("http://h.com/p.html", NESTED)], "url string, html string")
    row = A.extract(frame).first()
    assert row["article_body"] == (
        '<p>he</p><script src="w.js">"</div>e&eacute;"</script><!-- </div><a href="c"> --><style>p {}</style>'
        '<a href="http://h.com/d">e</a>'
    )
    assert row["article_body_no_html"] == "hee"
    assert [tuple(i) for i in row["images"]] == [
        ("http://h.com/in.png", "", "100%", None), ("http://h.com/open.png", "", None, None)
    ]
    assert A.extract(frame, keep_hidden=False).first()["article_body"] == '<p>he</p><a href="http://h.com/d">e</a>'


def jpeg(width: int, height: int, frame: int = 0xC0, before: bytes = b"") -> bytes:
    def segment(code: int, data: bytes) -> bytes:
        return bytes([0xFF, code]) + struct.pack(">H", len(data) + 2) + data

    size = struct.pack(">BHHB", 8, height, width, 1) + b"\x01\x11\x00"
    return b"\xff\xd8" + segment(0xE0, b"JFIF\0") + before + segment(frame, size) + segment(0xDA, b"") + b"\x01\x02\xff\xd9"


def test_image_headers(spark):
    def gif(kind):
        return kind + struct.pack("<HH", 513, 4) + b"\0\0\0;"

    comments = b"".join(b"\xff\xfe" + struct.pack(">H", 4) + b"\xff\xc0" for _ in range(5000))
    large = b"\xff\xe1" + struct.pack(">H", 65535) + b"\xff" * 65533
    whole = {
        "png": (png(7, 3), 7, 3), "wide png": (png(70_000, 1), 70_000, 1), "gif87": (gif(b"GIF87a"), 513, 4),
        "gif89": (gif(b"GIF89a"), 513, 4), "jpeg": (jpeg(640, 480), 640, 480), "progressive": (jpeg(3, 65535, 0xC2), 3, 65535),
        "many segments": (jpeg(9, 8, 0xC1, comments), 9, 8), "large segments": (jpeg(9, 8, 0xC0, large * 3), 9, 8),
        "fill bytes": (jpeg(5, 6, 0xC0, b"\xff" * 9 + b"\xff\xd0"), 5, 6),
    }
    cut = {
        "png": png(7, 3)[:23], "signature": png(7, 3)[:8], "gif": gif(b"GIF89a")[:9], "jpeg": jpeg(640, 480)[:16],
        "start": b"\xff\xd8", "scan first": b"\xff\xd8\xff\xda\0\2", "no marker": b"\xff\xd8abcdefgh",
        "length 0": b"\xff\xd8\xff\xe0\0\0" + jpeg(1, 1), "table": b"\xff\xd8\xff\xc4\0\x09" + b"\x01" * 7, "empty size": jpeg(0, 5),
    }
    other = {"empty": b"", "text": b"no image", "null": None, "png without its first byte": png(7, 3)[1:]}
    made = [(f"whole {n}", data) for n, (data, _, _) in whole.items()]
    made += [(f"cut {n}", data) for n, data in cut.items()] + [(f"other {n}", data) for n, data in other.items()]
    files = spark.createDataFrame([(n, d if d is None else bytearray(d)) for n, d in made], "path string, content binary")
    found = {r["image_url"]: tuple(r)[1:] for r in images.image_headers(files).collect()}
    assert len(found) == len(made)
    assert {n: found[f"whole {n}"] for n in whole} == {n: (w, h, None) for n, (_, w, h) in whole.items()}
    assert {found[f"cut {n}"] for n in cut} == {(None, None, images.TRUNCATED)}
    assert {found[f"other {n}"] for n in other} == {(None, None, images.NOT_AN_IMAGE)}
    assert images.image_headers(files.limit(0)).collect() == []


def test_image_sizes(spark, tmp_path):
    (tmp_path / "b.png").write_bytes(png(7, 3))
    (tmp_path / "broken.png").write_bytes(b"no image")
    (tmp_path / "cut.png").write_bytes(png(7, 3)[:20])
    name = F.element_at(F.split("origin", "/"), -1)
    sizes = images.image_sizes(spark, str(tmp_path), F.concat(F.lit("http://h.com/"), name))
    assert [tuple(r) for r in sizes.collect()] == [("http://h.com/b.png", 7, 3)]
    headers = images.image_headers(images.image_files(spark, str(tmp_path)), name)
    assert {r["image_url"]: r["reason"] for r in headers.collect()} == {
        "b.png": None, "broken.png": images.NOT_AN_IMAGE, "cut.png": images.TRUNCATED
    }
    body = '<div id="main"><p class="date">March 3, 2011</p><figure class="article-image"><img src="/{}"></figure></div>'
    made = [("http://h.com/p.html", body.format("b.png")), ("http://h.com/q.html", body.format("c.png"))]
    twice = sizes.unionByName(sizes.withColumn("height", F.col("height") - 1))
    rows = A.extract(spark.createDataFrame(made, "url string, html string"), sizes=twice)
    found = {r["url"]: r for r in rows.collect()}
    assert tuple(found["http://h.com/p.html"]["images"][0])[2:] == ("7", "3")
    assert found["http://h.com/p.html"]["reason"] is None
    assert found["http://h.com/q.html"]["reason"] == A.NO_IMAGE_SIZE


def test_month_ranges(spark):
    today = datetime.date(2016, 5, 20)
    assert archive.month_range(today=today) == (datetime.date(2002, 1, 1), datetime.date(2016, 5, 1))
    with pytest.raises(ValueError):
        archive.month_range("06/2004", "05/2004")
    assert archive.open_end(None, 2010, today) == "12/2010"
    assert archive.open_end(None, None, today) == "05/2016"
    span = archive.month_range("06/2002", "03/2004")
    found = [r["archive_url"] for r in archive.month_archives(spark, "http://h/", *span).orderBy("month").collect()]
    assert len(found) == 22 and found[0] == "http://h/2002/06/" and found[-1] == "http://h/2004/03/"
    assert "http://h/2003/01/" in found


def test_archive_links(spark):
    listing = (
        '<ul class="archive-list"><li><a href="a.html">1</a><ul><li><a href="b.html">x</a></ul><a>no</a>'
        '<a href="a.html">again</a></ul><a href="out.html">no</a><ul class="z archive-list"><a href=\'c.html\'></ul>'
    )
    made = [("http://h/2011/03/", listing), ("http://h/2011/09/", listing), ("http://h/2011/04/", None)]
    frame = spark.createDataFrame(made, "url string, html string")
    months = archive.month_archives(spark, "http://h/", *archive.month_range("02/2011", "04/2011"))
    found = {tuple(r) for r in archive.site_links(frame, months).collect()}
    assert found == {("http://h/2011/03/", f"http://h/2011/03/{x}.html") for x in "abc"}


@pytest.mark.parametrize("frequent", [1, 100_000])
def test_sizes_of_frequent_and_rare_images(spark, monkeypatch, frequent):
    monkeypatch.setattr(A, "_FREQUENT_IMAGES", frequent)
    given = [(f"p{i}", [("logo", None, "9"), (f"b{i}", None, None)]) for i in range(40)] + [("none", []), (None, [("logo", None, None)])]
    rows = spark.createDataFrame(given, "url string, images array<struct<image_url: string, image_width: string, image_height: string>>")
    rows = rows.withColumn("images", F.transform("images", lambda i: i.withField("image_caption", F.lit(""))))
    sizes = spark.createDataFrame([("logo", 3, 4), ("logo", 2, 7), ("b1", 5, 6), (None, 1, 1)], "image_url string, width int, height int")
    filled = A.with_image_sizes(rows, sizes)
    assert "Generate explode(sequence" not in filled._jdf.queryExecution().toString()
    found = {r["url"]: [(i["image_width"], i["image_height"]) for i in r["images"]] for r in filled.collect()}
    assert found == {None: [(None, None)], "none": []} | {
        f"p{i}": [("3", "9"), ("5", "6") if i == 1 else (None, None)] for i in range(40)}


def test_images_are_found_once_for_their_sizes(spark, monkeypatch, tmp_path):
    """Stored with an explode on top, pages without images were dropped by a filter that finds all images first."""
    plans = []
    real = A.stage

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, name)

    monkeypatch.setattr(A, "stage", noted)
    html = '<div id="main"><p class="date">March 1, 2011</p><figure class="article-image"><img src="i.png"></figure></div>'
    pages = spark.createDataFrame([("http://h/a.html", html), ("http://h/b.html", html.replace("figure", "span"))], "url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    sizes = spark.createDataFrame([("http://h/i.png", 3, 4)], "image_url string, width int, height int")
    rows = A.extract(spark.read.parquet(str(tmp_path / "pages")), A.NEWS_LAYOUT, sizes=sizes)
    found = {r["url"]: [(i["image_width"], i["image_height"]) for i in r["images"]] for r in rows.collect()}
    assert found == {"http://h/a.html": [("3", "4")], "http://h/b.html": []}
    (plan,) = [plan for name, plan in plans if name == "used_images"]
    opened = "<figure(?=[" # the pattern of a figure's opening tag, looked for in three places of one extraction
    assert plan.count("Filter") == 0 and 0 < plan.count(opened)


def test_an_element_is_cut_once_however_often_its_body_names_it(spark):
    page = '<i></i><figure class="x">one</figure><figure class="x">two <figure class="x">three</figure></figure>'
    figure = H.Selector("figure", "class", "x")
    once = H.all_inner_html(F.col("p"), figure)
    often = H.all_inner_html(F.col("p"), figure, lambda f: F.concat(f, F.lit("|"), f, F.lit("|"), f))
    sizes = [spark.range(1).select(F.lit(page).alias("p"), F.col("id")).select("id", x.alias("x")) for x in (once, often)]
    assert [r["x"] for r in sizes[1].collect()] == [["|".join([t] * 3) for t in r["x"]] for r in sizes[0].collect()]
    assert [len(r["x"]) for r in sizes[0].collect()] == [3]
    cuts = [x._jdf.queryExecution().analyzed().toString().count("named_struct(tags") or x._jdf.queryExecution().analyzed().toString().count("tags, regexp_extract_all") for x in sizes]
    assert cuts[0] == cuts[1] > 0
