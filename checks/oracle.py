"""The same results in SQL, written from the definitions and not from the Spark code."""

from __future__ import annotations

from checks.tables import NAMES, SITE, UPLOADS
from pressmark import constants as K
from pressmark.sinks import templates

ORACLE: dict[str, str] = {}

_HIDDEN = r"(?s)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
_TAGS = r"</?[a-zA-Z][^>]*>|<[!?/][^>]*>"
_REFS = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][-.a-zA-Z0-9]*);?"
_SLUG = r".*/([^/.]+)(?:.[^./]+$)*"
_ENDING = r".*/([^/]+)"


def q(text: str) -> str:
    """An SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def fold(x: str) -> str:
    single = f"translate({x}, 'éóèñüçêäöíÉÈÑÓÜÇÄÖÊÍ', 'eoenuceaoiEENOUCAOEI')"
    return f"regexp_replace(replace({single}, 'ß', 'ss'), '[^\\x00-\\x7F]', '', 'g')"


def drop(x: str, pattern: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, '', 'g')"


def decode(x: str) -> str:
    for reference, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = f"replace({x}, {q(reference)}, {q(char)})"
    return x


def escape(x: str) -> str:
    for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        x = f"replace({x}, {q(char)}, {q(reference)})"
    return x


def day(number: str) -> str:
    return f"CAST(DATE '1995-01-01' + CAST({number} % 2500 AS INTEGER) AS DATE)"


def filled(template: str, **values: str) -> str:
    """A template as an SQL concatenation."""
    sql = q(template)
    for name, value in values.items():
        sql = sql.replace("{" + name + "}", f"' || {value} || '")
    return f"({sql})"


_LAST_URL = "list_filter({x}, lambda h, i: NOT list_contains({x}[i + 1:], h))"

PAGES = f"""
hrefs AS (
  SELECT *, {day('page_id')} AS date,
    regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin,
    regexp_extract(url, {q(_SLUG)}, 1) AS slug,
    regexp_extract(url, {q(_ENDING)}, 1) AS ending,
    regexp_extract_all(html, '<a href="([^"]*)"', 1) AS refs,
    {drop('html', _HIDDEN)} AS clean
  FROM pages),
parts AS (
  SELECT *, {_LAST_URL.format(x='refs')} AS links,
    regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS whole_html,
    regexp_extract(clean, '(?s)<article>(.*?)</article>', 1) AS inner_html,
    regexp_extract(clean, '(?s)<h1>(.*?)</h1>', 1) AS h1
  FROM hrefs),
arts AS (
  SELECT *,
    strftime(date, '%Y-%m-%d') || '-' || slug || '.md' AS file_name,
    '<p><a href="' || url || '" title="Permalink to ' || slug || '">Source</a></p>' AS permalink,
    {fold(decode(drop('h1', _TAGS)))} AS title,
    {fold('whole_html')} AS body,
    {fold(decode(drop('inner_html', _TAGS)))} AS body_text
  FROM parts),
numbered AS (
  SELECT *, coalesce(sum(len(links) + 1) OVER (ORDER BY url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM arts),
ids AS (
  SELECT *, CAST(1000 + before + len(links) + 1 AS BIGINT) AS post_id,
    list_transform(links, lambda h, i: {{
      'id': CAST(CAST(1000 + before + i AS BIGINT) AS VARCHAR),
      'url': replace(origin || h, ' ', '%20'),
      'caption': 'Link "' || h || '"',
      'file': replace(regexp_extract(replace(origin || h, ' ', '%20'), {q(_ENDING)}, 1), '%', ''),
      'place': i}}) AS images,
    strftime(date, '%Y/%m/') AS folder,
    strftime(date, '%a, %d %b %Y 00:00:00 -0000') AS pub_date,
    strftime(date, '%Y-%m-%d 00:00:00') AS post_date
  FROM numbered)
"""


def listed(items: str, variable: str, text: str) -> str:
    return f"coalesce(list_aggregate(list_transform({items}, lambda {variable}, n: {text}), 'string_agg', ''), '')"


def captions(media: str) -> str:
    # image places count from 0 in the sizes: they are those of all links before repeats are dropped
    return listed(
        "images", "m",
        filled(
            templates.CAPTION, image_id="m.id", width="m.width", height="m.height", caption="m.caption",
            path=f"{q(UPLOADS + media)} || folder || m.file",
        ),
    )


# the width of an image is the place of its last mention among all links of the page
SIZED = f"""
sized AS (
  SELECT * REPLACE (list_transform(images, lambda m, n: {{
      'id': m.id, 'url': m.url, 'caption': m.caption, 'file': m.file,
      'width': CAST(100 + len(refs) - list_position(list_reverse(refs), links[n]) AS VARCHAR),
      'height': CAST(200 + len(refs) - list_position(list_reverse(refs), links[n]) AS VARCHAR)}}) AS images)
  FROM ids)
"""

_AUTHOR = "'Public Information Office'"
_CATEGORIES = [K.GENERIC_ACCOUNT, "Page"]
_FIXED_CATEGORIES = [(q(c), q(c.lower().replace(" ", "-"))) for c in _CATEGORIES]
_EDITED = filled(templates.POST_METADATA, key=q("_edit_last"), value="'1'")


def categories(template: str, names: list[tuple[str, str]]) -> str:
    return " || ".join(filled(template, name=name, nicename=nicename) for name, nicename in names)


def unquoted(x: str) -> str:
    return f"replace({x}, '\"', '''')"


def post(author: str, names: list[tuple[str, str]], metadata: str) -> str:
    return filled(
        templates.POST_ITEM,
        title=escape(unquoted("title")), pub_date="pub_date", post_id="CAST(post_id AS VARCHAR)",
        captions=captions("wp-content/uploads/"), body="body", permalink="permalink", author=author,
        post_date="post_date", slug="slug", categories=categories(templates.POST_CATEGORY, names), metadata=metadata,
    )


def attachments(author: str) -> str:
    return listed(
        "images", "m",
        filled(
            templates.ATTACHMENT_ITEM,
            image_id="m.id", upload_root=q(UPLOADS), folder="folder", ending="ending", pub_date="pub_date",
            author=author, image_url=escape("m.url"), caption="m.caption", post_date="post_date",
            post_id="CAST(post_id AS VARCHAR)", file="m.file",
        ),
    )


def markdown(author: str, names: list[tuple[str, str]], **optional: str) -> str:
    fields = ("subhead", "article_author", "role", "telephone", "message_from", "message_to")
    return filled(
        templates.MARKDOWN,
        title=unquoted("title"), author=author, post_id="CAST(post_id AS VARCHAR)",
        categories=categories(templates.CATEGORY_LINES, names),
        images=listed(
            "images", "m",
            filled(
                templates.MARKDOWN_IMAGE, image_url="m.url", image_id="m.id", caption=unquoted("m.caption"),
                upload_root=q(UPLOADS), folder="folder", ending="ending", file="m.file",
            ),
        ),
        captions=captions(""), body="body", permalink="permalink",
        **{name: f"coalesce({optional[name]}, '')" if name in optional else "''" for name in fields},
    )


POST = post(_AUTHOR, _FIXED_CATEGORIES, _EDITED)
ATTACHMENTS = attachments(_AUTHOR)
MARKDOWN = markdown(_AUTHOR, _FIXED_CATEGORIES)

ORACLE["article_rows"] = f"""
WITH cut AS (
  SELECT page_id, regexp_replace(url, '[?#].*', '') AS url, html,
    row_number() OVER (PARTITION BY regexp_replace(url, '[?#].*', '') ORDER BY page_id DESC) AS newest
  FROM pages),
parts AS (
  SELECT *, regexp_extract({drop('html', _HIDDEN)}, '(?s)<article>(.*?)</article>', 1) AS inner_html,
    regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h1
  FROM cut WHERE newest = 1)
SELECT url,
  strftime({day('page_id')}, '%Y-%m-%d') || '-' || regexp_extract(url, {q(_SLUG)}, 1) || '.md' AS file_name,
  {fold(decode(drop('h1', _TAGS)))} AS title, {_AUTHOR} AS author,
  {fold(decode(drop('inner_html', _TAGS)))} AS article_body_no_html
FROM parts"""

_NAMES = ", ".join(q(n) for n in NAMES)
_ACCOUNTS = ", ".join(f"({q(alias)}, {q(account)})" for alias, account in K.AUTHOR_ACCOUNTS.items())
NEWS = f"""
named AS (
  SELECT *, {day('doc_id')} AS date, CAST(doc_id AS VARCHAR) AS n,
    [{_NAMES}][doc_id % {len(NAMES)} + 1] AS name
  FROM documents WHERE doc_id % 17 <> 7 AND doc_id % 11 <> 3 AND doc_id % 13 <> 5),
located AS (
  SELECT *, {q(SITE)} || strftime(date, '/%Y/%m/') || 'doc-' || n || '.html' AS url FROM named)
"""
_KEPT = '<!-- <p>hidden</p> --><script>w("</div><a href=x>&eacute;");</script><style>a {}</style>'
_FIELDS = f"""
SELECT url,
  strftime(date, '%Y-%m-%d') || '-doc-' || n || '.md' AS file_name,
  '<p><a href="' || url || '" title="Permalink to doc-' || n || '">Source</a></p>' AS source_permalink,
  coalesce(account, {_AUTHOR}) AS author,
  CASE WHEN account IS NULL THEN name END AS article_author,
  CASE WHEN doc_id % 7 <> 4 THEN 'Writer' END AS article_author_title,
  CASE WHEN doc_id % 6 <> 1 THEN '555-' || n END AS article_author_telephone,
  lang || '|A & B' AS categories,
  CASE WHEN doc_id % 2 = 0 THEN 'Dean ' || n END AS message_from,
  CASE WHEN doc_id % 2 = 0 THEN 'All' END AS message_to,
  CAST(date AS VARCHAR) AS date, 'Title "' || n || '" cafe' AS title,
  CASE WHEN doc_id % 5 <> 2 THEN 'Sub "' || source || '"' END AS subhead,
  '<p>' || {fold(escape('text'))} || '</p>{_KEPT}<div><a class="more" href="{SITE}/doc/' || n
    || '?a=1&amp;b=2">more</a></div><a name="here"></a>' AS article_body,
  {fold('text')} || 'more' AS article_body_no_html
FROM located LEFT JOIN accounts ON alias = lower(name)"""
NEWS_FIELDS = f"{NEWS}, accounts(alias, account) AS (VALUES {_ACCOUNTS}), fields AS ({_FIELDS})"
ORACLE["article_fields"] = f"WITH {NEWS_FIELDS} SELECT * FROM fields"
# two images and a post for every article
NEWS_IDS = f"""
{NEWS_FIELDS}, numbered AS (
  SELECT *, source_permalink AS permalink, article_body AS body, row_number() OVER (ORDER BY url) - 1 AS nth
  FROM fields JOIN (SELECT url, n, lang, date AS day FROM located) USING (url)),
sized AS (
  SELECT *, CAST(1003 + 3 * nth AS BIGINT) AS post_id, 'doc-' || n AS slug, 'doc-' || n || '.html' AS ending,
    strftime(day, '%Y/%m/') AS folder, strftime(day, '%a, %d %b %Y 00:00:00 -0000') AS pub_date,
    strftime(day, '%Y-%m-%d 00:00:00') AS post_date,
    [{{'id': CAST(CAST(1001 + 3 * nth AS BIGINT) AS VARCHAR), 'url': '{SITE}/pics/a%20' || n || '.jpg',
       'caption': 'One ' || n, 'file': 'a20' || n || '.jpg', 'width': '30', 'height': '20'}},
     {{'id': CAST(CAST(1002 + 3 * nth AS BIGINT) AS VARCHAR), 'url': '{SITE}' || strftime(day, '/%Y/') || 'b%20' || n || '.png',
       'caption': '', 'file': 'b20' || n || '.png', 'width': '', 'height': ''}}] AS images
  FROM numbered)
"""
NEWS_POST = post(
    "author", [("lang", "lang"), ("'A & B'", "'a-&amp;-b'")],
    _EDITED + "".join(
        " || coalesce(" + filled(templates.POST_METADATA, key=q(k), value=unquoted(k) if k == "subhead" else k) + ", '')"
        for k in ("subhead", "article_author", "article_author_title", "article_author_telephone", "message_from", "message_to")
    ),
)
NEWS_ITEM = f"{NEWS_POST} || {attachments('author')}"
NEWS_MARKDOWN = markdown(
    "author", [("lang", "lang"), ("'A & B'", "'a-&-b'")], subhead=unquoted("subhead"), article_author="article_author",
    role="article_author_title", telephone="article_author_telephone", message_from="message_from", message_to="message_to",
)
ORACLE["image_sizes_filled"] = f"""
WITH {NEWS}, known AS (SELECT * FROM located JOIN part ON p_partkey = doc_id)
SELECT url, '{SITE}/pics/a%20' || n || '.jpg' AS image_url, '30' AS image_width, '20' AS image_height FROM known
UNION ALL
SELECT url, '{SITE}' || strftime(date, '/%Y/') || 'b%20' || n || '.png', CAST(p_size AS VARCHAR), CAST(p_size + 1 AS VARCHAR) FROM known
UNION ALL
SELECT url, '{SITE}/logo.png', CAST((SELECT max(p_size) FROM part) AS VARCHAR), '1em' FROM known"""
ORACLE["article_images"] = f"""
WITH {NEWS}
SELECT url, '{SITE}/pics/a%20' || n || '.jpg' AS image_url, 'One ' || n AS image_caption,
  '30' AS image_width, '20' AS image_height FROM located
UNION ALL
SELECT url, '{SITE}' || strftime(date, '/%Y/') || 'b%20' || n || '.png', '', NULL, NULL FROM located"""
ORACLE["reject_report"] = """
SELECT CASE WHEN doc_id % 17 = 7 THEN 'no main section' ELSE 'article does not contain a date' END AS reason,
  count(*) AS pages
FROM documents WHERE doc_id % 17 = 7 OR doc_id % 11 = 3 OR doc_id % 13 = 5 GROUP BY 1"""
ORACLE["page_accept"] = """
SELECT url, CASE WHEN page_id % 9 = 4 THEN 'status 404'
  WHEN page_id % 7 = 3 THEN 'content type not text/html; charset=UTF-8' END AS reason FROM pages"""
ORACLE["month_archives"] = f"""
SELECT CAST(CAST(m AS DATE) AS VARCHAR) AS month, {q(SITE)} || strftime(m, '/%Y/%m/') AS archive_url
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
  INTERVAL 1 MONTH)) AS m FROM orders)"""
ORACLE["month_range_scan"] = """
SELECT strftime(o_orderdate, '%Y/%m') AS month, count(*) AS orders FROM orders
WHERE o_orderdate >= DATE '1996-06-01' AND o_orderdate < DATE '1999-04-01' GROUP BY 1"""
ORACLE["archive_links"] = """
SELECT DISTINCT url AS archive_url, url || unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS article_url
FROM pages"""
_IN_MONTHS = f"{day('page_id')} BETWEEN DATE '1995-02-01' AND DATE '1995-06-30'"
_MONTH_URL = f"{q(SITE)} || strftime({day('page_id')}, '/%Y/%m/')"
ORACLE["site_links"] = f"""
SELECT {_MONTH_URL} AS archive_url, {_MONTH_URL} || kind || 'p' || page_id || '.html' AS article_url
FROM pages, (VALUES (''), ('q')) AS kinds(kind) WHERE {_IN_MONTHS}"""
ORACLE["articles_in_range"] = f"""
WITH {PAGES}
SELECT {q(SITE)} || strftime(date, '/%Y/%m/') || 'p' || page_id || '.html' AS url,
  strftime(date, '%Y-%m-%d') || '-p' || page_id || '.md' AS file_name, title, body_text AS article_body_no_html
FROM arts WHERE {_IN_MONTHS}"""
ORACLE["page_headers"] = f"""
SELECT page_id, {fold(decode(drop("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)", _TAGS)))} AS heading,
  {fold(decode(drop("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)", _TAGS)))} AS title FROM pages"""
ORACLE["article_text"] = f"""
WITH {PAGES} SELECT page_id, body AS article_body, body_text AS article_body_no_html FROM arts"""
ORACLE["absolute_links"] = f"""
WITH {PAGES}, each AS (SELECT url, origin, unnest(refs) AS href FROM hrefs)
SELECT url, href, origin || href AS link FROM each"""
ORACLE["image_paths"] = f"""
WITH {PAGES}, each AS (SELECT url, replace(origin || unnest(refs), 'e', '%20') AS image_url FROM hrefs)
SELECT url, image_url, replace(regexp_extract(image_url, {q(_ENDING)}, 1), '%', '') AS file FROM each"""
ORACLE["author_account"] = f"""
SELECT doc_id, coalesce(n_name, {_AUTHOR}) AS author,
  CASE WHEN n_name IS NULL THEN upper(source) || CASE WHEN doc_id % 3 = 0 THEN ' JR' ELSE '' END END AS article_author
FROM documents LEFT JOIN nation ON source = 'src' || n_nationkey AND doc_id % 3 <> 0"""
ORACLE["parse_dates"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1, 5) OR o_orderkey % 6 = 2 AND month(o_orderdate) = 5
  THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders"""
ORACLE["date_formats"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/') AS folder,
  strftime(o_orderdate, '%a, %d %b %Y 00:00:00 -0000') AS rfc2822,
  strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS midnight FROM orders"""
ORACLE["dedupe_url"] = f"""
SELECT regexp_extract(url, {q(_SLUG)}, 1) AS slug, max(page_id) AS page_id, arg_max(url, page_id) AS url
FROM pages GROUP BY 1"""
ORACLE["object_ids"] = f"""
WITH {PAGES} SELECT url, post_id,
  coalesce(list_aggregate(list_transform(images, lambda m: m.id), 'string_agg', ','), '') AS image_ids FROM ids"""


def shards(item: str) -> str:
    return f"""
items AS (
  SELECT *, {item} AS item, row_number() OVER (ORDER BY url) AS place FROM sized),
lengths AS (SELECT place, octet_length(encode(item)) AS bytes FROM items),
shards AS (
  SELECT place, 0 AS file_no, {len(templates.IMPORT_HEADER)} + bytes AS size FROM lengths WHERE place = 1
  UNION ALL
  SELECT l.place, CASE WHEN s.size > 40000 THEN s.file_no + 1 ELSE s.file_no END,
    CASE WHEN s.size > 40000 THEN {len(templates.IMPORT_HEADER)} ELSE s.size END + l.bytes
  FROM shards s JOIN lengths l ON l.place = s.place + 1)
"""


_SHARDS = shards(f"{POST} || {ATTACHMENTS}")
_FILES = f"""
SELECT 'import-' || file_no || '.xml' AS file_name,
  {q(templates.IMPORT_HEADER)} || string_agg(item, '' ORDER BY place) || {q(templates.IMPORT_FOOTER)} AS content
FROM items JOIN shards USING (place) GROUP BY file_no"""
ORACLE["import_shards"] = f"""
WITH RECURSIVE {PAGES}, {SIZED}, {_SHARDS}
SELECT CAST(file_no AS BIGINT) AS file_no, count(*) AS items, CAST(max(size) AS BIGINT) AS bytes
FROM shards GROUP BY 1"""
ORACLE["import_files"] = f"WITH RECURSIVE {PAGES}, {SIZED}, {_SHARDS} {_FILES}"
ORACLE["import_news_files"] = f"WITH RECURSIVE {NEWS_IDS}, {shards(NEWS_ITEM)} {_FILES}"
ORACLE["render_news_items"] = f"WITH {NEWS_IDS} SELECT url, {NEWS_ITEM} AS item FROM sized"
ORACLE["render_news_markdown"] = f"""
WITH {NEWS_IDS} SELECT file_name, arg_max({NEWS_MARKDOWN}, url) AS content FROM sized GROUP BY 1"""
ORACLE["render_items"] = f"WITH {PAGES}, {SIZED} SELECT url, {POST} AS item FROM sized"
ORACLE["render_attachments"] = f"WITH {PAGES}, {SIZED} SELECT url, {ATTACHMENTS} AS items FROM sized"
ORACLE["render_captions"] = f"WITH {PAGES}, {SIZED} SELECT url, {captions('')} AS captions FROM sized"
ORACLE["render_markdown"] = f"""
WITH {PAGES}, {SIZED} SELECT file_name, arg_max({MARKDOWN}, url) AS content FROM sized GROUP BY 1"""

DOCS = """
docs AS (
  SELECT doc_id, text, list_filter([lang, source, CASE WHEN quality = 1 THEN 'quality' END,
    CASE WHEN toxic = 1 THEN 'toxic' END], lambda c: c IS NOT NULL) AS categories
  FROM documents JOIN labels USING (doc_id))
"""
_PIPED = "array_to_string({}, '|')"
_MARKER = K.CORPUS_MARKER
ORACLE["corpus_render"] = f"""
WITH {DOCS} SELECT doc_id, '{_MARKER}' || chr(10)
  || array_to_string(list_transform(categories, lambda c: 'category: ' || c || chr(10)), '')
  || '{_MARKER}' || chr(10) || text || chr(10) AS content FROM docs"""
ORACLE["corpus_parse"] = f"""
WITH {DOCS} SELECT doc_id, {_PIPED.format('categories')} AS categories, text || chr(10) AS article_body,
  false AS unclosed FROM docs"""
ORACLE["front_matter_parse"] = f"""
WITH body AS (SELECT page_id, url, html || chr(10) || 'end' || chr(10) AS body FROM pages)
SELECT page_id, 'url: ' || url || chr(10) AS metadata, body AS article_body,
  {fold(drop(drop(drop('body', _HIDDEN), _TAGS), _REFS))} AS article_body_no_html FROM body"""
ORACLE["render_categorised"] = f"""
WITH {DOCS} SELECT doc_id, '---' || chr(10) || 'id: ' || doc_id || chr(10) || 'categories:' || chr(10)
  || array_to_string(list_transform(categories, lambda c: '  - name: ' || c || chr(10)
       || '    nicename: ' || replace(lower(c), ' ', '-') || chr(10)), '')
  || '---' || chr(10) || text AS content FROM docs"""
ORACLE["training_from_articles"] = f"""
WITH {PAGES}
SELECT file_name, arg_max({_AUTHOR} || '|' || title, url) AS categories, arg_max(body_text, url) AS article_body
FROM arts GROUP BY 1"""
ORACLE["label_filter"] = """
SELECT doc_id, array_to_string(list_filter([lang, source], lambda c: c NOT IN ('fr', 'src3')), '|') AS categories
FROM documents"""
ORACLE["label_filter_counts"] = f"""
WITH {DOCS}, left_over AS (
  SELECT len(list_filter(categories, lambda c: c NOT IN ('en', 'fr') AND NOT starts_with(c, 'src'))) AS n FROM docs)
SELECT count(*) FILTER (n > 0) AS kept, count(*) FILTER (n = 0) AS removed FROM left_over"""
_VOCABULARY = """
named AS (SELECT DISTINCT doc_id, unnest(categories) AS category FROM docs),
vocabulary AS (
  SELECT category, row_number() OVER (ORDER BY category) - 1 AS label_id
  FROM (SELECT DISTINCT category FROM named))
"""
ORACLE["label_vocab"] = f"WITH {DOCS}, {_VOCABULARY} SELECT label_id, category FROM vocabulary"
ORACLE["label_encode"] = f"""
WITH {DOCS}, {_VOCABULARY} SELECT doc_id, label_id FROM named JOIN vocabulary USING (category)"""
ORACLE["label_decode"] = f"""
WITH {DOCS}, {_VOCABULARY} SELECT doc_id, string_agg(category, '|' ORDER BY category) AS categories
FROM named GROUP BY 1"""

_MATRIX = """
cells AS (
  SELECT 'quality' AS label, quality = 1 AS t, n_chars >= 2000 AS p FROM labels JOIN documents USING (doc_id)
  UNION ALL
  SELECT 'toxic', toxic = 1, n_chars <= 500 FROM labels JOIN documents USING (doc_id)
  UNION ALL
  SELECT 'unused ' || lang, false, false FROM labels, (SELECT DISTINCT lang FROM documents)),
counts AS (
  SELECT label, count(*) FILTER (t AND p) AS tp, count(*) FILTER (p AND NOT t) AS fp,
    count(*) FILTER (t AND NOT p) AS fn, count(*) FILTER (NOT t AND NOT p) AS tn
  FROM cells GROUP BY label),
rates AS (
  SELECT *, CASE WHEN fp = 0 THEN 1.0::DOUBLE ELSE tp / (tp + fp) END AS precision,
    CASE WHEN fn = 0 THEN 1.0::DOUBLE ELSE tp / (tp + fn) END AS recall FROM counts)
"""
ORACLE["confusion_by_label"] = f"""
WITH {_MATRIX} SELECT label, tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1
FROM rates"""
ORACLE["confusion_totals"] = f"""
WITH {_MATRIX} SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
  CAST(sum(tn) AS BIGINT) AS tn FROM counts"""
ORACLE["metrics_macro"] = f"""
WITH {_MATRIX}, means AS (SELECT avg(precision) AS p, avg(recall) AS r FROM rates)
SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM means"""
ORACLE["metrics_micro"] = f"""
WITH {_MATRIX}, means AS (
  SELECT sum(tp) / (sum(tp) + sum(fp)) AS p, sum(tp) / (sum(tp) + sum(fn)) AS r FROM counts)
SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM means"""

ORACLE["kfold_sizes"] = """
SELECT count(*) AS sample, count(*) // 7 AS slice, count(*) % 7 AS remainder FROM documents"""


def folds(order: str) -> str:
    return f"""
placed AS (SELECT doc_id, row_number() OVER (ORDER BY {order}) - 1 AS position,
  (SELECT count(*) // 7 FROM documents) AS size FROM documents),
folded AS (SELECT doc_id, position, CAST(least(position // size, 7) AS INTEGER) AS fold FROM placed)
"""


ORACLE["kfold_assign"] = f"WITH {folds('doc_id')} SELECT * FROM folded"
ORACLE["shuffled_folds"] = f"WITH {folds('(doc_id * 48271 + 42) % 2147483647, doc_id')} SELECT * FROM folded"
ORACLE["kfold_split"] = f"""
WITH {folds('doc_id')} SELECT doc_id, CASE WHEN fold = 2 THEN 'test' ELSE 'train' END AS part FROM folded"""

_GRAMS = r"""
words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
grams AS (SELECT doc_id, w || list_transform(w[1:-2], lambda x, i: x || ' ' || w[i + 1]) AS g FROM words)
"""
_COUNTS = f"""
{_GRAMS}, terms AS (SELECT doc_id, unnest(g) AS term FROM grams),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
frequencies AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM counts GROUP BY 1)
"""
ORACLE["tokenise"] = f"WITH {_GRAMS} SELECT doc_id, array_to_string(w, '|') AS tokens FROM words"
ORACLE["word_ngrams"] = f"WITH {_GRAMS} SELECT doc_id, array_to_string(g, '|') AS terms FROM grams"
ORACLE["tfidf_terms"] = f"WITH {_COUNTS} SELECT term, df, tf FROM frequencies"
ORACLE["tfidf_weights"] = f"""
WITH {_COUNTS}, raw AS (
  SELECT doc_id, term, c.tf, df, c.tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1) AS raw
  FROM counts c JOIN frequencies USING (term))
SELECT doc_id, term, tf, df, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw"""

_SCORES = r"""
WITH words AS (SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS known,
  regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
grams AS (SELECT doc_id, known, w || list_transform(w[1:-2], lambda x, i: x || ' ' || w[i + 1]) AS g FROM words),
counts AS (SELECT doc_id, known, term, count(*) AS tf FROM (SELECT doc_id, known, unnest(g) AS term FROM grams) GROUP BY ALL),
frequent AS (SELECT term, count(*) AS df FROM counts WHERE known GROUP BY term HAVING count(*) >= 3),
terms AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id,
  ln((1.0 + (SELECT count(*) FROM words WHERE known)) / (1.0 + df)) + 1 AS scale FROM frequent),
vals AS (SELECT doc_id, term_id, tf * scale / sqrt(sum(tf * scale * tf * scale) OVER (PARTITION BY doc_id)) AS v
  FROM counts JOIN terms USING (term) WHERE NOT known),
names AS (SELECT unnest([lang, source, CASE WHEN quality = 1 THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END]) AS category
  FROM documents JOIN labels USING (doc_id)),
lab AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS label_id FROM (SELECT DISTINCT category FROM names WHERE category IS NOT NULL)),
part AS (SELECT doc_id, label_id, sum(v * ((term_id * 37 + label_id * 101) % 201 - 100) / 100.0) AS part
  FROM vals JOIN lab ON (term_id + label_id) % 5 = 0 GROUP BY ALL)
SELECT doc_id, category, round(coalesce(part, 0) + (label_id % 5 - 2) / 10.0, 6) AS score
FROM (SELECT doc_id FROM words WHERE NOT known) CROSS JOIN lab LEFT JOIN part USING (doc_id, label_id)"""
ORACLE["score_with_model"] = ORACLE["score_by_tables"] = _SCORES
_PLANTED = """
SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 2 = 0 THEN 'even' END,
  CASE WHEN doc_id % 2 <> 0 AND doc_id % 3 <> 0 THEN 'other' END, CASE WHEN doc_id % 3 = 0 THEN 'third' END], lambda x: x IS NOT NULL), '|') AS categories
FROM documents"""
ORACLE["classify_planted"] = f"{_PLANTED} WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
ORACLE["kfold_planted"] = """
WITH placed AS (SELECT doc_id, row_number() OVER (ORDER BY (doc_id * 48271 + 42) % 2147483647, doc_id) - 1 AS position,
  (SELECT count(*) // 3 FROM documents) AS size FROM documents),
folded AS (SELECT doc_id, CAST(position // size AS INTEGER) AS fold FROM placed WHERE position // size < 3),
marks AS (SELECT fold, unnest([{'label': 'even', 'own': doc_id % 2 = 0}, {'label': 'third', 'own': doc_id % 3 = 0},
  {'label': 'other', 'own': doc_id % 2 <> 0 AND doc_id % 3 <> 0}]) AS m FROM folded)
SELECT fold, m.label AS label, count(*) FILTER (WHERE m.own) AS tp, CAST(0 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS fn,
  count(*) FILTER (WHERE NOT m.own) AS tn, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1
FROM marks GROUP BY fold, m.label"""

ORACLE["url_slug"] = f"SELECT url, nullif(regexp_extract(url, {q(_SLUG)}, 1), '') AS slug FROM pages"
ORACLE["url_ending"] = f"SELECT url, nullif(regexp_extract(url, {q(_ENDING)}, 1), '') AS ending FROM pages"
ORACLE["nicename"] = """
SELECT name, replace(lower(name), ' ', '-') AS nicename
FROM (SELECT p_type AS name FROM part UNION SELECT n_name FROM nation)"""
ORACLE["cp1252_repair"] = "SELECT doc_id, translate(text, 'aeiou', '€“”™–') AS text FROM documents"
ORACLE["ascii_fold"] = f"SELECT doc_id, {fold('text')} AS text FROM documents"
ORACLE["strip_tags"] = f"""
SELECT page_id, {drop(drop(drop('html', _HIDDEN), _TAGS), _REFS)} AS text FROM pages"""
ORACLE["squeeze_spaces"] = r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents"
