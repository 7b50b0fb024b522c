"""HTML fields by built-in expressions.

Elements that may hold their own kind (``div``, ``span``, ``ul``) are cut out by
counting opening and closing tags inside the row, so no Python worker and no tree is
needed. Elements that cannot nest are found by one pattern.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from pressmark.functions.text import decode_references, literal, once, sql_apply, sql_once

# Attributes of a tag, quoted values whole; a new tag ends them. Repeated groups are possessive everywhere: they
# never backtrack and use no stack, so a hostile page cannot fail a task.
_ATTRS = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
_ANY_TAG = r"<[a-zA-Z/!?][^>]*+>"
_NOT_NESTING = {"p", "h1", "title", "figcaption", "a", "meta"}
_BLOCK = r"(?:p|div|ul|ol|h[1-6]|section|article|figure|footer|table)"


@dataclass(frozen=True)
class Selector:
    """An element name and, optionally, one attribute: a class token or an exact value."""

    tag: str
    attribute: str | None = None
    value: str | None = None

    def open_tag(self) -> str:
        """Pattern of the opening tag."""
        start = rf"<{self.tag}(?=[\s/>])"
        if self.attribute is None:
            return rf"{start}{_ATTRS}>"
        want = f"(?-i:{re.escape(self.value)})"
        token = rf"(?:[^\"'>]*\s)?{want}(?:\s[^\"'>]*)?" if self.attribute == "class" else want
        test = rf"""(?:"{token}"|'{token}'|{want}(?=[\s>/]))"""
        return rf"{start}{_to_attribute(self.attribute)}{test}{_ATTRS}>"


def _to_attribute(name: str) -> str:
    """Pattern of the rest of a tag up to the value of its first attribute of this name."""
    return rf"""(?:\s++(?!{name}\s*=)|"[^"]*+"|'[^']*+'|[^\s"'<>]++)*+\s++{name}\s*+=\s*+"""


# Comments, scripts and styles, which hold no elements.
_HIDDEN = r"(?s)<(?:!--.*?-->|(?i:script)\b[^>]*+>.*?</(?i:script)\s*>|(?i:style)\b[^>]*+>.*?</(?i:style)\s*>)"
# Noncharacters, which no text may hold: begin and end of a masked part, and its brackets.
_BEGIN, _END, _LESS, _GREATER = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"


def mask_hidden(html: Column) -> Column:
    """Mark comments, scripts and styles and change their brackets, so that no pattern finds a tag in them."""

    def mark(part: Column) -> Column:
        return F.concat(F.lit(_BEGIN), F.translate(part, "<>", _LESS + _GREATER), F.lit(_END))

    def marked(h: Column) -> Column:
        parts = F.regexp_extract_all(h, F.lit(_HIDDEN), 0)
        pairs = F.zip_with(
            F.split(h, _HIDDEN), parts, lambda text, part: F.concat(text, F.coalesce(mark(part), F.lit("")))
        )
        return F.array_join(pairs, "")

    marks = _BEGIN + _END + _LESS + _GREATER
    free = F.when(html.rlike(f"[{marks}]"), F.translate(html, marks, "")).otherwise(html)
    return once(free, lambda h: F.when(h.rlike("(?i)<(?:!--|script|style)"), marked(h)).otherwise(h))


def without_masked(html: Column) -> Column:
    return F.regexp_replace(html, f"{_BEGIN}[^{_END}]*+{_END}", "")


def map_shown(html: Column, shown: Callable[[Column], Column], hidden: Callable[[Column], Column]) -> Column:
    """Apply one function to what is between masked parts and another to these parts as they were."""

    def piece(p: Column) -> Column:
        bare = F.translate(p, _LESS + _GREATER + _BEGIN + _END, "<>")
        return F.when(p.startswith(_BEGIN), hidden(bare)).otherwise(shown(p))

    return F.array_join(F.transform(F.split(html, f"(?={_BEGIN})|(?<={_END})"), piece), "")


def without_hidden(html: Column, keep_script: bool = False) -> Column:
    """Drop comments and, unless told otherwise, script and style elements."""
    return F.regexp_replace(html, "(?s)<!--.*?-->" if keep_script else _HIDDEN, "")


def _inner_flat(html: Column, selector: Selector) -> Column:
    end = rf"</{selector.tag}\b"
    if selector.tag == "p":
        end = rf"</?{_BLOCK}\b"
    element = F.regexp_extract(html, rf"(?is)({selector.open_tag()}.*?)(?={end}|\z)", 1)
    return once(element, lambda e: F.when(e != "", F.regexp_replace(e, rf"^<{_ATTRS}>", "")))


def _cut_element(rest: Column, tag: str) -> Column:
    """Inner HTML of the element whose opening tag ``rest`` begins with."""
    any_tag = literal(rf"(?i)</?{tag}(?=[\s/>]){_ATTRS}>")
    deeper = "CASE WHEN startswith(tag, '</') THEN -1 WHEN endswith(tag, '/>') THEN 0 ELSE 1 END"
    stepped = (
        f"named_struct('depth', state.depth + {deeper}, 'used', state.used + 1,"
        f" 'closed', state.depth + {deeper} = 0)"
    )

    def pieces(r: str) -> str:
        return f"named_struct('tags', regexp_extract_all({r}, {any_tag}, 0), 'texts', split({r}, {any_tag}))"

    def length(p: str) -> str:
        return (
            f"aggregate({p}.tags, named_struct('depth', 0, 'used', 0, 'closed', false),"
            f" (state, tag) -> CASE WHEN state.closed THEN state ELSE {stepped} END,"
            f" state -> CASE WHEN state.closed THEN state.used - 1 ELSE state.used END)"
        )

    def joined(p: str, n: str) -> str:
        # the first tag is the opening one and the first text, before it, is empty
        return (
            f"array_join(zip_with(slice({p}.texts, 2, {n}), slice({p}.tags, 2, greatest({n} - 1, 0)),"
            f" (text, tag) -> concat(text, coalesce(tag, ''))), '')"
        )

    def cut(p: str) -> str:
        return sql_once(length(p), lambda n: joined(p, n), "n")

    return sql_apply(lambda r: sql_once(pieces(r), cut, "parts"), rest)


def inner_html(html: Column, selector: Selector) -> Column:
    """Inner HTML of the first element that matches; null when there is none.

    An element that is never closed reaches to the end.
    """
    if selector.tag in _NOT_NESTING:
        return _inner_flat(html, selector)
    rest = F.regexp_extract(html, rf"(?is)({selector.open_tag()}.*)\z", 1)
    return once(rest, lambda r: F.when(r != "", _cut_element(r, selector.tag)))


def all_inner_html(
    html: Column, selector: Selector, body: Callable[[Column], Column] = lambda inner: inner
) -> Column:
    """``body`` of the inner HTML of every matching element, nested ones too, in order of their opening tags.

    The page is cut before every opening tag. An element that ends before the next opening is
    cut out of its own piece, so only pages with nested matches read a piece more than once.
    """
    opened, closed = F.lit(rf"(?i)<{selector.tag}(?=[\s/>])"), F.lit(rf"(?i)</{selector.tag}(?=[\s/>])")

    def element(pieces: Column, piece: Column, i: Column) -> Column:
        whole = F.regexp_count(piece, closed) >= F.regexp_count(piece, opened)
        rest = F.when(whole, piece).otherwise(F.array_join(F.slice(pieces, i + 1, F.size(pieces)), ""))
        return once(_cut_element(rest, selector.tag), body)  # the body names it several times

    def elements(pieces: Column) -> Column:
        found = F.transform(pieces, lambda piece, i: F.when(i > 0, element(pieces, piece, i)))
        return once(found, lambda f: F.slice(f, 2, F.size(f)))

    # the space keeps an opening at the very beginning from being the first piece
    return once(F.split(F.concat(F.lit(" "), html), rf"(?is)(?={selector.open_tag()})"), elements)


def open_tags(html: Column, selector: Selector) -> Column:
    """Every matching opening tag, in order."""
    return F.regexp_extract_all(html, F.lit(rf"(?is){selector.open_tag()}"), 0)


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of an attribute of an opening tag; null when it is absent."""
    value = r"""("[^"]*+"|'[^']*+'|[^\s>"']++)"""
    pattern = rf"(?i)^<[a-z][^\s>/]*+{_to_attribute(name)}{value}"

    def bare(raw: Column) -> Column:
        return F.when(raw != "", decode_references(F.regexp_replace(raw, r"""^["']|["']$""", "")))

    return once(F.regexp_extract(tag, pattern, 1), bare)


def _without_tags(html: Column) -> Column:
    """Drop tags. No tag ends after the last ``>``, so none is looked for there, which bounds the time."""

    def dropped(h: Column) -> Column:
        rest = F.substring_index(h, ">", -1)
        return once(rest, lambda r: F.concat(F.regexp_replace(F.left(h, F.length(h) - F.length(r)), _ANY_TAG, ""), r))

    return once(html, lambda h: F.when(h.contains("<"), dropped(h)).otherwise(h))


def strip_tags(html: Column, keep_script: bool = False) -> Column:
    """Character data only: tags, declarations, comments and character references are dropped."""
    text = _without_tags(without_hidden(html, keep_script))
    return F.regexp_replace(text, r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][-.a-zA-Z0-9]*);?", "")


def visible_text(html: Column) -> Column:
    """Text of HTML without hidden parts: tags dropped without a space, character references decoded."""
    return decode_references(_without_tags(html))


def text_of(html: Column, selector: Selector) -> Column:
    """Visible text of the first element that matches; null when there is none."""
    return visible_text(inner_html(html, selector))


def map_text(html: Column, text_function: Callable[[Column], Column]) -> Column:
    """Apply a function to the text between tags, leaving the tags as they are."""
    tag = r"""^(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>"""

    def after_tag(p: Column) -> Column:
        mark = F.regexp_extract(p, f"({tag})", 1)
        return once(mark, lambda m: F.concat(F.lit("<"), m, text_function(F.substr(p, F.length(m) + F.lit(1)))))

    def piece(p: Column, i: Column) -> Column:
        return F.when(i > 0, after_tag(p)).otherwise(text_function(p))

    return F.array_join(F.transform(F.split(html, "<"), piece), "")


def map_link_targets(html: Column, target_function: Callable[[Column], Column]) -> Column:
    """Rewrite ``a@href``, ``img@src`` and ``iframe@src``; elements without the attribute stay."""
    before = rf"<a(?=\s){_to_attribute('href')}|<(?:img|iframe)(?=\s){_to_attribute('src')}"
    link = rf"""(?i)^({before})("[^"]*+"|'[^']*+'|[^\s>"']++)"""

    def written(p: Column, raw: Column) -> Column:
        bare = decode_references(F.regexp_replace(raw, r"""^["']|["']$""", ""))
        absolute = F.replace(target_function(bare), F.lit("&"), F.lit("&amp;"))
        return F.concat(
            F.regexp_extract(p, link, 1),
            F.lit('"'), F.replace(absolute, F.lit('"'), F.lit("&quot;")), F.lit('"'),
            F.regexp_replace(p, link, ""),
        )

    def piece(p: Column) -> Column:
        return once(F.regexp_extract(p, link, 2), lambda raw: F.when(raw == "", p).otherwise(written(p, raw)))

    return F.array_join(F.transform(F.split(html, r"(?i)(?=<(?:a|img|iframe)\s)"), piece), "")
