from __future__ import annotations

import datetime
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pressmark import constants as K
from pressmark.functions import dates, html as H, text, urls
from pressmark.functions.html import Selector

SLOW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_fold_table():
    assert len(K.CP1252_FROM) == len(K.CP1252_TO) == 27
    assert all(value.isascii() and not key.isascii() for key, value in K.ASCII_FORMS.items())


def test_ascii_fold(each):
    cases = {
        "plain": "plain",
        "“Straße” … œuvre €5 ™": '"Strasse" ... oeuvre EUR5 (tm)',
        "e\x93x\x94 \x80": 'e"x" EUR',
        "a b c": "a b c",
        "Ångström Łódź ŀ": "Angstrom Lodz l",
        "漢字 ok": " ok",
    }
    assert each(text.ascii_fold, list(cases)) == list(cases.values())


@SLOW
@given(st.lists(st.text(), min_size=1, max_size=60))
def test_folded_text_is_ascii(each, texts):
    for before, after in zip(texts, each(text.ascii_fold, texts)):
        assert after.isascii()
        if before.isascii():
            assert after == before


def test_decode_references(each):
    cases = {
        "a &amp; b &#233; &#xe9; &nope; &copy; &": "a & b é é &nope; © &",
        "&amp;lt; &quot;x&quot;": '&lt; "x"',
        "&#99999999; &#xD800;": "&#99999999; &#xD800;",
    }
    assert each(text.decode_references, list(cases)) == list(cases.values())
    kept = each(lambda c: text.decode_references(c, markup=False), ["&lt;b&gt; &eacute; &#60; &#233;"])
    assert kept == ["&lt;b&gt; é &#60; é"]


def test_cp1252_repair(each):
    assert each(text.repair_cp1252, ["\x80\x91\x9f\x81"]) == ["€‘Ÿ\x81"]


def test_small_text_functions(each):
    assert each(text.nicename, ["Press Release Now"]) == ["press-release-now"]
    assert each(text.squeeze_spaces, [" a \n\t b  c "]) == ["a b c"]
    assert each(text.single_quotes, ['a "b"']) == ["a 'b'"]
    assert each(text.tokens, ["The Cat_1 a é ou été"]) == [["the", "cat_1", "ou", "été"]]
    grams = each(lambda c: text.word_ngrams(text.tokens(c)), ["aa bb cc", "aa", ""])
    assert grams == [["aa", "bb", "cc", "aa bb", "bb cc"], ["aa"], []]


def test_slug_and_ending(each):
    cases = {
        "http://x/a/b.html": ("b", "b.html"),
        "http://x/a/b.html?x=1.2": ("b", "b.html?x=1.2"),
        "http://x/a/": ("a", "a"),
        "noslash": (None, None),
        "http://x/a.tar.gz": ("a", "a.tar.gz"),
    }
    assert each(urls.slug, list(cases)) == [s for s, _ in cases.values()]
    assert each(urls.ending, list(cases)) == [e for _, e in cases.values()]


@SLOW
@given(st.lists(st.text(alphabet="ab/.?#:- "), min_size=1, max_size=80))
def test_slug_has_no_slash_or_dot(each, texts):
    for found in each(urls.slug, texts):
        assert found is None or not set("/.") & set(found)


def test_resolve_equals_the_standard_library(each):
    bases = ["http://a.com/b/c/d.html?q=1#f", "http://a.com", "https://a.com/x/", "http://a.com/x/y"]
    hrefs = [
        "", "#z", "?k=v", "/r/s", "g", "./g", "../g", "../../g", "../../../g", "g/", "//h.com/p", "g?y#s",
        "http://x.y/z", "mailto:a@b", "./", "../", "/a/../b", "/a/./b?x=../y", "a b.png", "x/../y/./z",
    ]
    pairs = [(base, href) for base in bases for href in hrefs]
    assert each(urls.resolve, pairs) == [urljoin(*pair) for pair in pairs]


def test_media_names(each):
    assert each(urls.percent_spaces, ["/a b c"]) == ["/a%20b%20c"]
    assert each(urls.media_file_name, ["http://x/p/a%20b.jpg"]) == ["a20b.jpg"]


def test_dates(each):
    cases = {
        "on december 12, 2014 by": datetime.date(2014, 12, 12),
        "December  12,\n 2014": datetime.date(2014, 12, 12),
        "March 05, 2014": datetime.date(2014, 3, 5),
        "Dec 12, 2014": None,
        "December12, 2014": None,
        "December 12,2014": None,
        "February 30, 2014": None,
        "12/12/2014": None,
    }
    found = each(lambda c: dates.parse_month_day_year(dates.date_text(c)), list(cases))
    assert found == list(cases.values())
    day = ["2014-12-12"]
    assert each(lambda c: dates.rfc2822(c.cast("date")), day) == ["Fri, 12 Dec 2014 00:00:00 -0000"]
    west = each(lambda c: dates.rfc2822(c.cast("date"), "America/Los_Angeles"), day)
    assert west == ["Fri, 12 Dec 2014 08:00:00 -0000"]
    assert each(lambda c: dates.midnight_text(c.cast("date")), day) == ["2014-12-12 00:00:00"]


def test_month_arguments():
    assert dates.month_of("02/2003") == (2, 2003)
    for bad in ("13/2003", "2/2003", "02/20034", "", "x02/2003"):
        with pytest.raises(ValueError):
            dates.month_of(bad)


def test_elements(each):
    page = (
        "<body><div id=\"x\"><DIV class=\"a\" ID='main' data-x=\"1>2\">hi <div>in<div/>ner</div> "
        '<p class="first date"> On <b>May 1, 2010</b> <p>next</p> <span class="name">A <span>B</span> C</span>'
        " tail</div></div> after</body>"
    )
    main = each(
        lambda c: H.inner_html(c, Selector("div", "id", "main")),
        [page, "none", '<div id="main">open <div>x</div> y', '<div id="mainx">n</div><div id=main>z</div>'],
    )
    assert main[0].startswith("hi <div>") and main[0].endswith(" tail")
    assert main[1:] == [None, "open <div>x</div> y", "z"]
    assert each(lambda c: H.text_of(c, Selector("p", "class", "date")), [page]) == [" On May 1, 2010 "]
    names = [page, '<span class="names">x</span><span class="x name y">q</span>', ""]
    assert each(lambda c: H.text_of(c, Selector("span", "class", "name")), names) == ["A B C", "q", None]
    lists = '<ul class="l"><li>1<ul><li>2</ul></ul><ul class="l">3</ul><ul>4</ul>'
    assert each(lambda c: H.all_inner_html(c, Selector("ul", "class", "l")), [lists]) == [
        ["<li>1<ul><li>2</ul>", "3"]
    ]


def test_attributes(each):
    tags = [
        '<img src="a b.png">', "<img alt='src=\"no\"' SRC='y?a=1&amp;b=2'/>", "<img  data-src=z   src=q>",
        "<img>", "<img " + "a" * 5000 + ">", "<img " + "a=b " * 2000 + ">",
    ]
    assert each(lambda c: H.attribute(c, "src"), tags) == ["a b.png", "y?a=1&b=2", "q", None, None, None]


def test_hostile_pages(each):
    """Long repeats neither overflow the stack nor take quadratic time."""
    pages = [
        "<div " + "a=b " * 20000 + ">x</div>", "<div " + "a='b' " * 20000, "<div>" * 20000, "</div>" * 20000,
        "<" * 20000, "<p " * 20000, "&" * 20000, "<!--" * 5000, '<div id="main">' + "<i>x</i>" * 20000 + "</div>",
        "<a href='x'" + '"' * 20001, " " * 20000 + "<p class='date'>",
    ]
    found = each(lambda c: H.inner_html(H.without_hidden(c), Selector("div", "id", "main")), pages)
    assert found[8] == "<i>x</i>" * 20000 and [f for f in found if f] == [found[8]]
    each(lambda c: H.map_link_targets(H.map_text(c, text.ascii_fold), lambda t: urls.resolve(c, t)), pages)
    each(lambda c: H.text_of(c, Selector("p", "class", "date")), pages)
    each(lambda c: text.squeeze_spaces(H.strip_tags(c)), pages)


def test_strip_tags(each):
    page = '<p>a&amp;b &copy c&#65;</p><!-- x <b> --> 1 < 2 <!DOCTYPE x><script>var t="</p>";</script>end'
    assert each(H.strip_tags, [page]) == ["ab  c 1 < 2 end"]
    assert "var t=" in each(lambda c: H.strip_tags(c, keep_script=True), [page])[0]


def test_text_and_link_rewriting(each):
    page = '<p title="é">é<a name=x>1</a><a class=b href="/für?a=1&amp;b=2">2</a><IMG alt=1 SRC=p.png></p>'
    assert each(lambda c: H.map_text(c, text.ascii_fold), [page])[0].startswith('<p title="é">e<a name=x>1</a>')
    linked = each(lambda b, c: H.map_link_targets(c, lambda t: urls.resolve(b, t)), [("http://h/d/e", page)])[0]
    assert 'href="http://h/für?a=1&amp;b=2">2' in linked
    assert 'SRC="http://h/d/p.png">' in linked and "<a name=x>1</a>" in linked


def test_references_with_leading_zeros_and_further_latin_letters(each):
    assert each(text.decode_references, ["&#00000038;", "&#x000000e9;", "&#0;", "&#00000000000;", "&#x0;", "&#99999999;"])[:2] == ["&", "é"]
    assert each(text.ascii_fold, ["ș ț ế ơ Ṡ"]) == ["s t e o S"]
