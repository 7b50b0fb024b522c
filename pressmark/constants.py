"""They must be exactly these for results to be right."""

from __future__ import annotations

import unicodedata
from html.entities import name2codepoint

# Fixed value: the only content type a page is accepted with.
ACCEPTED_CONTENT_TYPE = "text/html; charset=UTF-8"

# Fixed value: the line around the label block of a training document.
CORPUS_MARKER = "---classification-training-metadata---"

# Fixed value: the line around the metadata of a front-matter document.
FRONT_MATTER_MARKER = "---"

# Labels that say where a page is shown, not what it is about.
EXCLUDED_LABELS = ("Regular News", "Secondary Story", "Home Page")

# Fixed value: the account for authors without one of their own.
GENERIC_ACCOUNT = "Public Information Office"

# Lower-case author name to account.
AUTHOR_ACCOUNTS = {
    "tim stephens": "Tim Stephens",
    "jennifer mcnulty": "Jennifer McNulty",
    "scott rappaport": "Scott Rappaport",
    "gwen mickelson": "Gwen Jourdonnais",
    "gwen jourdonnais": "Gwen Jourdonnais",
    "dan white": "Daniel White",
    "daniel white": "Daniel White",
    "scott hernandez-jason": "Scott Hernandez-Jason",
    "peggy townsend": "Peggy Townsend",
    "public information office": "Public Information Office",
}

# Fixed value: an import file is closed once it is larger than this many bytes.
IMPORT_FILE_LIMIT = 5_242_880

# Fixed value: first month of the archive.
FIRST_MONTH = "01/2002"

# Fixed pattern: month and year arguments.
MONTH_PATTERN = r"(\d{2})/(\d{4})"

# Fixed patterns: last path part up to its first dot, and the whole last path part.
SLUG_PATTERN = r".*/([^/.]+)(?:.[^./]+$)*"
ENDING_PATTERN = r".*/([^/]+)"

# Fixed pattern: a date such as "December 12, 2014" inside other text.
DATE_PATTERN = r"[A-Za-z]+\s*\d{1,2},\s*\d{4}"

# Fixed pattern: words of two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Windows-1252 reads these bytes as text where ISO 8859-1 has control characters.
# Python's codec is the rule; the five undefined bytes stay as they are.
_C1 = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
CP1252_FROM = "".join(map(chr, _C1))
CP1252_TO = "".join(bytes([b]).decode("cp1252") for b in _C1)

# ASCII forms that are not just a letter without its accent.
ASCII_FORMS = {
    "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "¦": "|", "§": "SS",
    "¨": '"', "©": "(c)", "ª": "a", "«": "<<", "¬": "!", "®": "(r)", "¯": "-", "°": "deg",
    "±": "+-", "²": "2", "³": "3", "´": "'", "µ": "u", "¶": "P", "·": "*", "¸": ",", "¹": "1",
    "º": "o", "»": ">>", "¼": "1/4", "½": "1/2", "¾": "3/4", "¿": "?", "Æ": "AE", "Ð": "D",
    "×": "x", "Ø": "O", "Þ": "Th", "ß": "ss", "æ": "ae", "ð": "d", "÷": "/", "ø": "o", "þ": "th",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ĳ": "IJ", "ĳ": "ij", "ĸ": "k", "Ŀ": "L",
    "ŀ": "l", "Ł": "L", "ł": "l", "ŉ": "'n", "Ŋ": "NG", "ŋ": "ng", "Œ": "OE", "œ": "oe", "Ŧ": "T",
    "ŧ": "t", "ſ": "s", "ƒ": "f", "ˆ": "^", "˜": "~",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "‖": "||", "‗": "_",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "‟": '"', "†": "+",
    "‡": "++", "•": "*", "‣": "*>", "․": ".", "‥": "..", "…": "...", "‧": ".",
    "‰": "%0", "‱": "%00", "′": "'", "″": "''", "‴": "'''",
    "‵": "`", "‶": "``", "‷": "```", "‸": "^", "‹": "<", "›": ">", "※": "*", "‼": "!!", "‽": "!?",
    "‾": "-", "‿": "_", "⁄": "/", "⁇": "??", "⁈": "?!", "⁉": "!?", "€": "EUR", "™": "(tm)",
}

# Spaces and line separators.
ASCII_FORMS |= {chr(code): " " for code in (0xA0, 0x202F, *range(0x2000, 0x200B))}
ASCII_FORMS |= {"\u2028": "\n", "\u2029": "\n\n"}


def _unaccented() -> dict[str, str]:
    """Accented Latin letters by Unicode decomposition: Latin-1, Extended-A, Extended-B, Additional."""
    letters = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and chr(code) not in ASCII_FORMS:
            letters[chr(code)] = base
    return letters


ASCII_FORMS |= _unaccented()
# Windows-1252 bytes take the form of the character they mean
ASCII_FORMS |= {c1: ASCII_FORMS[char] for c1, char in zip(CP1252_FROM, CP1252_TO)}

ASCII_SINGLE = {k: v for k, v in ASCII_FORMS.items() if len(v) == 1}
ASCII_WIDER = {k: v for k, v in ASCII_FORMS.items() if len(v) > 1}

# Named character references, from the standard library's table.
ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
