"""Text folding as JVM-side column expressions.

The character tables are derived from ``unicodedata`` by rule, once per driver process, and
reach the executors as literals.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_SURROGATES = range(0xD800, 0xE000)
_HANGUL = range(0xAC00, 0xD7A4)


def _base_letters(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")


def _ascii_letters(char: str) -> str:
    return unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")


@lru_cache
def _tables(fold) -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(from, to) for one-to-one folds, and the one-to-many folds as pairs."""
    source, target, many = [], [], []
    for code in range(0x80, 0x30000):
        if code in _SURROGATES or code in _HANGUL:
            continue
        char = chr(code)
        folded = fold(char)
        if folded == char or not folded:
            continue
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        else:
            many.append((char, folded))
    return "".join(source), "".join(target), tuple(many)


@lru_cache
def _marks() -> str:
    """The combining marks; the JVM's own list may be of an older Unicode version."""
    return "".join(chr(c) for c in range(0x300, 0xE01F0) if unicodedata.category(chr(c)) == "Mn")


def _fold(col: Column, fold, drop: str) -> Column:
    """Replace each non-ASCII character that folds to something else, or is one of ``drop``.

    One table lookup per character folds to one letter or none. A text with a character that folds to
    several, which is rare, has each of its distinct ones replaced in turn instead. Folded letters fold to
    themselves, so the order does not matter.
    """
    source, target, many = _tables(fold)
    # Characters of the first text without a partner in the second are dropped.
    single = lambda text: F.translate(text, source + drop, target)
    expansions = F.str_to_map(
        F.lit("\x01".join(f"{a}\x02{b}" for a, b in many)), F.lit("\x01"), F.lit("\x02")
    )

    def folded(char: Column) -> Column:
        return F.coalesce(F.try_element_at(expansions, char), single(char))

    rest = F.regexp_replace(col, r"[\x00-\x7F]+", "")
    changed = F.filter(F.array_distinct(F.split(rest, "")), lambda c: folded(c) != c)
    each = F.reduce(changed, col, lambda text, c: F.replace(text, c, folded(c)))
    short = F.translate(col, "".join(a for a, _ in many), "")
    return F.when(F.octet_length(short) == F.octet_length(col), single(col)).otherwise(each)


def _is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.char_length(col)


def strip(col: Column) -> Column:
    """Trim every Unicode white space character, not only the space."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(strip(col) == "", F.lit(True))


def normalize(col: Column) -> Column:
    """Trimmed, without accents, lower case; null becomes the empty text."""
    text = strip(F.coalesce(col.cast("string"), F.lit("")))
    folded = _fold(text, _base_letters, drop=_marks())
    return F.lower(F.when(_is_ascii(text), text).otherwise(folded))


def normalize_py(text: str | None) -> str:
    """``normalize`` for driver-side constants."""
    stripped = "" if text is None else str(text).strip()
    return "".join(_base_letters(c) for c in stripped).lower()


def light_normalize(col: Column) -> Column:
    """Trimmed and lower case, accents kept; null becomes the empty text."""
    return F.lower(strip(F.coalesce(col.cast("string"), F.lit(""))))


def _to_ascii(col: Column) -> Column:
    # What has no ASCII form can be a whole script: dropped at once, not character by character.
    folded = F.regexp_replace(_fold(col, _ascii_letters, drop=""), r"[^\x00-\x7F]+", "")
    return F.when(_is_ascii(col), col).otherwise(folded)


def clean_ascii(col: Column) -> Column:
    """Trimmed text in ASCII: compatibility forms unfolded, everything else dropped."""
    return _to_ascii(strip(F.coalesce(col.cast("string"), F.lit(""))))


def safe_name(col: Column, default: str = "chronogramme") -> Column:
    """File-safe lower case name; ``default`` where nothing is left."""
    text = _to_ascii(F.coalesce(col.cast("string"), F.lit("")))
    joined = F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_")
    return F.coalesce(F.nullif(F.lower(F.btrim(joined, F.lit("._-"))), F.lit("")), F.lit(default))
