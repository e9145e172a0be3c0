"""Text and code helpers (Column -> Column)."""

from __future__ import annotations

import os

from pyspark.sql import Column, functions as F

from pricewright import values
from pricewright.functions.numbers import column


def drop_chars(c: Column | str, chars: str) -> Column:
    return F.translate(column(c), chars, "")


def fold_accents(c: Column | str) -> Column:
    """Upper-case accented letters become their base letter."""
    return F.translate(column(c), values.ACCENTED, values.UNACCENTED)


def norm_key(
    c: Column | str, fold: bool = True, strip: str = values.KEY_DROPPED, upper: bool = True
) -> Column:
    """Join key of a free-text name: trimmed, upper-cased, accents folded, punctuation dropped."""
    key = F.trim(column(c))
    key = F.upper(key) if upper else key
    source, target = (values.ACCENTED, values.UNACCENTED) if fold else ("", "")
    return F.translate(key, source + strip, target) if source + strip else key


def code_int(c: Column | str) -> Column:
    """A code without its leading zeros, as a number; null for codes with letters."""
    return F.trim(column(c)).try_cast("bigint")


def has_digits(c: Column | str, digits: int) -> Column:
    """True for a numeric code of exactly ``digits`` significant digits."""
    return F.coalesce(code_int(c).between(10 ** (digits - 1), min(10**digits, 2**63) - 1), F.lit(False))


def pad_code(c: Column | str, width: int = 10) -> Column:
    """A zero before the code, then its last ``width`` characters: a longer code keeps its end."""
    return F.right(F.concat(F.lit("0"), column(c)), F.lit(width))


def minimal_terms(terms: list[str]) -> list[str]:
    """Terms that do not already contain another term: the others can never add a match."""
    kept: list[str] = []
    for term in sorted(set(terms), key=lambda t: (len(t), t)):
        if not any(short in term for short in kept):
            kept.append(term)
    return kept


def contains_any(c: Column | str, terms: list[str]) -> Column:
    """True when the text holds any of the literal terms (one pass, not one test per term)."""
    kept = minimal_terms(terms)
    shared = os.path.commonprefix(kept)
    tails = "|".join(_quote(term[len(shared) :]) for term in kept)
    return column(c).rlike(f"{_quote(shared)}(?:{tails})")


def _quote(text: str) -> str:
    return f"\\Q{text}\\E" if text else ""


def display_key(*parts: Column | str, sep: str = "_") -> Column:
    """Readable key; null when any part is null, so it never merges unlike rows."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i and sep:
            pieces.append(F.lit(sep))
        pieces.append(column(part).cast("string"))
    return F.concat(*pieces)


def strip_dashes(c: Column | str) -> Column:
    """Drop runs of two or more dashes from a material text."""
    return F.trim(F.regexp_replace(column(c), "-{2,}", ""))
