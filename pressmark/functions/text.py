"""Text functions over string columns. All are built-in expressions, no Python workers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from pressmark import constants as K

_ENTITY = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` worked out once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def literal(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_once(value: str, body: Callable[[str], str], name: str) -> str:
    """As :func:`once`, for SQL texts; ``name`` is the variable."""
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def sql_apply(body: Callable[[str], str], value: Column) -> Column:
    """An SQL expression of one column, worked out once.

    Large expressions are written as SQL: building them call by call takes the driver seconds.
    """
    return F.call_function("transform", F.array(value), F.expr(f"value -> {body('value')}"))[0]


def _map_literal(entries: dict[str, str]) -> str:
    """A constant map, folded by the optimiser."""
    packed = "\x01".join(f"{key}\x02{value}" for key, value in entries.items())
    return f"str_to_map({literal(packed)}, '\x01', '\x02')"


def nicename(name: Column) -> Column:
    """Spaces to dashes, lower case."""
    return F.lower(F.replace(name, F.lit(" "), F.lit("-")))


def repair_cp1252(text: Column) -> Column:
    """C1 control characters to the characters Windows-1252 means by them."""
    return F.translate(text, K.CP1252_FROM, K.CP1252_TO)


def ascii_fold(text: Column) -> Column:
    """Repair Windows-1252, write Latin text in ASCII, drop what has no ASCII form.

    Pure ASCII text is passed through after one scan; the wider replacements run only
    on what is still not ASCII after the one-to-one ones.
    """
    letters = f"{literal(''.join(K.ASCII_SINGLE))}, {literal(''.join(K.ASCII_SINGLE.values()))}"
    wide = r"[^\x00-\x7F]"

    def is_ascii(t: str) -> str:
        return f"octet_length({t}) = char_length({t})"

    def spelled(p: str) -> str:
        known = f"coalesce(element_at({_map_literal(K.ASCII_WIDER)}, left({p}, 1)), '')"
        return f"CASE WHEN {p} RLIKE {literal('^' + wide)} THEN concat({known}, substr({p}, 2)) ELSE {p} END"

    def widened(t: str) -> str:
        return f"array_join(transform(split({t}, {literal(f'(?={wide})')}), p -> {spelled('p')}), '')"

    def folded(t: str) -> str:
        narrowed = f"translate({t}, {letters})"
        return sql_once(narrowed, lambda u: f"CASE WHEN {is_ascii(u)} THEN {u} ELSE {widened(u)} END", "narrowed")

    return sql_apply(lambda t: f"CASE WHEN {is_ascii(t)} THEN {t} ELSE {folded(t)} END", text)


def squeeze_spaces(text: Column) -> Column:
    """Runs of non-space joined by one space."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def single_quotes(text: Column) -> Column:
    return F.replace(text, F.lit('"'), F.lit("'"))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def decode_references(text: Column, markup: bool = True) -> Column:
    """Named, decimal and hexadecimal character references to characters, unknown ones kept.

    ``markup=False`` keeps references to ASCII characters, so that HTML stays HTML.
    """
    known = {k: v for k, v in K.ENTITIES.items() if markup or not v.isascii()}
    lowest = 1 if markup else 0x80

    def number(ref: str, start: int) -> str:
        return f"regexp_replace(substr({ref}, {start}), '^0+', '')"

    def code_point(digits: str, base: int) -> str:
        value = f"CAST(conv({digits}, {base}, 10) AS BIGINT)"
        usable = (
            f"length({digits}) <= 7 AND {value} BETWEEN {lowest} AND {0x10FFFF}"
            f" AND NOT {value} BETWEEN {0xD800} AND {0xDFFF}"
        )
        return f"CASE WHEN {usable} THEN decode(unhex(lpad(hex({value}), 8, '0')), 'UTF-32') END"

    def character(ref: str) -> str:
        return (
            f"CASE WHEN {ref} = '' THEN NULL"
            f" WHEN {ref} RLIKE '^#[xX]' THEN {code_point(number(ref, 3), 16)}"
            f" WHEN startswith({ref}, '#') THEN {code_point(number(ref, 2), 10)}"
            f" ELSE element_at({_map_literal(known)}, {ref}) END"
        )

    def piece(p: str, i: str) -> str:
        found = sql_once(
            f"regexp_extract({p}, {literal(_ENTITY)}, 1)",
            lambda ref: f"concat({character(ref)}, substr({p}, length({ref}) + 2))",
            "ref",
        )
        return f"CASE WHEN {i} = 0 THEN {p} ELSE coalesce({found}, concat('&', {p})) END"

    def decoded(t: str) -> str:
        return f"array_join(transform(split({t}, '&'), (p, i) -> {piece('p', 'i')}), '')"

    return sql_apply(lambda t: f"CASE WHEN contains({t}, '&') THEN {decoded(t)} ELSE {t} END", text)


def tokens(text: Column) -> Column:
    """Lower-case words of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(K.TOKEN_PATTERN), 0)


def word_ngrams(words: Column) -> Column:
    """Every word, then every pair of neighbouring words joined by a space."""

    def with_pairs(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.concat(w, pairs)

    return once(words, with_pairs)
