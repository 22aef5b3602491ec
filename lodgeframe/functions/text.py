"""Text and number cleaning expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode sees it, plus the four ASCII separators.
_SPACE = r"[\s\x1c-\x1f]"


def trim_space(c: Column) -> Column:
    """Trim Unicode white space on both sides (Spark's ``trim`` removes blanks only)."""
    return F.regexp_replace(c, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def trimmed_or_blank(c: Column) -> Column:
    return F.coalesce(trim_space(c), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip_html(c: Column) -> Column:
    """Every ``<...>`` becomes a blank, white space runs collapse, ends are trimmed; NULL gives ''."""
    no_tags = F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " ")
    return F.trim(F.regexp_replace(no_tags, rf"(?U){_SPACE}+", " "))


def to_int(c: Column) -> Column:
    """Number or numeric text to INT, truncating toward zero; anything else is NULL."""
    return c.try_cast("double").try_cast("int")


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Number or numeric text to DECIMAL; NULL when it is neither or does not fit."""
    return c.try_cast(f"decimal({precision},{scale})")


def parse_iso_timestamp(c: Column) -> Column:
    """ISO-8601 text with an optional offset; blank or unreadable text is NULL."""
    return F.try_to_timestamp(blank_to_null(trim_space(c)))


def truthy(c: Column) -> Column:
    """JSON truth value of a scalar read as text; NULL is false."""
    return F.coalesce(~F.lower(c).isin("", "false", "0", "0.0"), F.lit(False))


# --- slugs ---------------------------------------------------------------------------------

# Latin letters without a canonical decomposition, and their ASCII spelling.
_LATIN_SINGLE = {"Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ł": "L", "ł": "l", "Ħ": "H", "ħ": "h", "ı": "i", "Ŧ": "T", "ŧ": "t"}
_LATIN_MULTI = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Þ": "Th", "þ": "th", "Ĳ": "IJ", "ĳ": "ij"}
# HTML entities that occur in names.
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": " ", "&amp;": "&"}


def _latin_folding() -> tuple[str, str]:
    """Accented Latin letters and their base letters, derived from Unicode decomposition."""
    pairs = dict(_LATIN_SINGLE)
    for start, stop in ((0x00C0, 0x0250), (0x1E00, 0x1F00)):
        for code in range(start, stop):
            base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
            if len(base) == 1 and base.isascii() and base.isalpha():
                pairs[chr(code)] = base
    return "".join(pairs), "".join(pairs.values())


_FOLD_FROM, _FOLD_TO = _latin_folding()

# Latin spellings of Greek and Cyrillic letters, in alphabetical order.
_GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split()))
_CYRILLIC = dict(
    zip("абвгдеёжзийклмнопрстуфхцчшщыэюяєіїґ", "a b v g d e io zh z i i k l m n o p r s t u f kh ts ch sh shch y e iu ia ie i yi g".split())
)


def _spelled() -> dict[str, str]:
    """Lower-case letters of both scripts, accented ones by their base letters; hard and soft signs vanish."""
    out = {**_GREEK, **_CYRILLIC, "ъ": "", "ь": ""}
    for code in (*range(0x0370, 0x0400), *range(0x1F00, 0x2000)):
        char = chr(code).lower()
        base = unicodedata.normalize("NFKD", char)[0]
        if base in _GREEK:
            out.setdefault(char, _GREEK[base])
    return out


_SPELLED = _spelled()
_SINGLE = {c: t for c, t in _SPELLED.items() if len(t) == 1}
_NOT_LATIN = "[\u0370-\u03ff\u0400-\u04ff\u1f00-\u1fff]"


def _romanised(s: Column) -> Column:
    """Greek and Cyrillic letters in Latin ones; texts without them are passed on as they are."""
    out = F.translate(F.lower(s), "".join(_SINGLE), "".join(_SINGLE.values()))
    for letter, spelled in _SPELLED.items():
        if len(spelled) != 1:
            out = F.replace(out, F.lit(letter), F.lit(spelled))
    return F.when(s.rlike(_NOT_LATIN), out).otherwise(s)


def slugify(c: Column) -> Column:
    """ASCII slug: accents folded, Greek and Cyrillic spelled out, other characters become single dashes. NULL gives ''."""
    s = F.coalesce(c, F.lit(""))
    for entity, char in _ENTITIES.items():
        s = F.replace(s, F.lit(entity), F.lit(char))
    for letter, spelled in _LATIN_MULTI.items():
        s = F.replace(s, F.lit(letter), F.lit(spelled))
    s = F.lower(F.translate(_romanised(s), _FOLD_FROM, _FOLD_TO))
    s = F.regexp_replace(s, r"[̀-ͯ‘’]", "")  # combining marks, curly apostrophes
    s = F.regexp_replace(s, r"(?<=\d),(?=\d)", "")
    return F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "-"), "^-|-$", "")


# --- markup --------------------------------------------------------------------------------


def xml_escape(c: Column) -> Column:
    out = c
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def iso_timestamp(c: Column) -> Column:
    """ISO text of a UTC timestamp; the fraction (six digits) is printed only when it is not zero."""
    seconds = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, ".SSSSSS")
    return F.concat(seconds, F.when(micros == ".000000", "").otherwise(micros))
