"""URL functions over string columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressmark import constants as K
from pressmark.functions.text import literal, null_if_empty, sql_once

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*:)"
_ORIGIN = r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)"


def slug(url: Column) -> Column:
    """Last path part up to its first dot; null when there is none."""
    return null_if_empty(F.regexp_extract(url, K.SLUG_PATTERN, 1))


def ending(url: Column) -> Column:
    """Last non-empty path part with its extension; null when there is none."""
    return null_if_empty(F.regexp_extract(url, K.ENDING_PATTERN, 1))


def percent_spaces(url: Column) -> Column:
    return F.replace(url, F.lit(" "), F.lit("%20"))


def media_file_name(url: Column) -> Column:
    """File name as the import tool stores it: percent signs are dropped."""
    return F.replace(ending(url), F.lit("%"), F.lit(""))


def without_query(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*", "")


def _flatten_dots(path: str) -> str:
    """Apply ``.`` and ``..`` parts of an absolute path, as SQL."""
    step = (
        "CASE WHEN part = '.' THEN kept"
        " WHEN part = '..' THEN slice(kept, 1, greatest(size(kept) - 1, 1))"
        " ELSE concat(kept, array(part)) END"
    )

    def flat(p: str) -> str:
        slash = f"CASE WHEN {p} RLIKE {literal(r'/[.]{1,2}$')} THEN '/' ELSE '' END"
        kept = f"aggregate(split({p}, '/'), CAST(array() AS ARRAY<STRING>), (kept, part) -> {step})"
        return f"concat(array_join({kept}, '/'), {slash})"

    dotted = literal(r"(^|/)[.]{1,2}(/|$)")
    return sql_once(path, lambda p: f"CASE WHEN {p} RLIKE {dotted} THEN {flat(p)} ELSE {p} END", "path")


def resolve(base: Column, href: Column) -> Column:
    """The absolute form of ``href`` found on the page ``base`` (RFC 3986, section 5.2)."""
    scheme = literal(_SCHEME)
    origin = f"regexp_extract(base, {literal(_ORIGIN)}, 1)"
    folder = f"regexp_extract(base, {literal(_ORIGIN[:-1] + '(?:/[^?#]*)?/)')}, 1)"
    folder = f"substr(coalesce(nullif({folder}, ''), concat({origin}, '/')), length({origin}) + 1)"
    path = f"regexp_extract(href, {literal('^([^?#]*)')}, 1)"
    tail = f"regexp_extract(href, {literal('^[^?#]*(.*)')}, 1)"
    cases = (
        f"CASE WHEN href = '' THEN base"
        f" WHEN startswith(href, '//') THEN concat(regexp_extract(base, {scheme}, 1), href)"
        f" WHEN startswith(href, '/') THEN concat({origin}, {_flatten_dots(path)}, {tail})"
        f" WHEN href RLIKE {scheme} THEN href"
        f" WHEN startswith(href, '#') THEN concat(regexp_replace(base, '#.*', ''), href)"
        f" WHEN startswith(href, '?') THEN concat(regexp_replace(base, '[?#].*', ''), href)"
        f" ELSE concat({origin}, {_flatten_dots(f'concat({folder}, {path})')}, {tail}) END"
    )
    resolved = F.call_function("zip_with", F.array(base), F.array(href), F.expr(f"(base, href) -> {cases}"))
    return resolved[0]
