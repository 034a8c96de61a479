"""Identifier and ISSN expressions.

All of them are plain Catalyst expressions evaluated in the JVM.  Null or blank input always
gives null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ISSN_SHAPE = "^[0-9]{7}[0-9X]$"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    """Trim all white space; blank text becomes null."""
    trimmed = F.regexp_replace(as_column(value), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return bound(trimmed, lambda t: F.when(t != "", t))


def entity_id(value: Column | str, letter: str) -> Column:
    """Canonical id of a source (``S``) or work (``W``): the letter and its digits.

    Text without such an id is kept trimmed, so that it can still be told
    apart from a missing id.
    """

    def odd(c: Column) -> Column:
        digits = F.regexp_extract(c, f"(?i){letter}[^0-9A-Za-z]*([0-9]+)", 1)
        return F.when(F.length(digits) > 0, F.concat(F.lit(letter), digits)).otherwise(blank_to_null(c))

    c = as_column(value)
    # Ids that are written canonically, nearly all of them, stay inside generated code and take one match.
    return F.when(c.rlike(f"^{letter}[0-9]+$"), c).otherwise(bound(c, odd))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    Nested expressions that repeat their input grow with every level until generated code no longer compiles.
    """
    return F.transform(F.array(value), body)[0]


def issn_key(value: Column | str) -> Column:
    """Letters and digits in upper case; null when nothing is left."""
    return bound(F.upper(F.regexp_replace(as_column(value), "[^0-9A-Za-z]", "")), lambda k: F.when(k != "", k))


def issn_dashed(key: Column | str) -> Column:
    """``NNNN-NNNC`` of a key made by :func:`issn_key`; other lengths stay as they are."""
    return F.regexp_replace(as_column(key), "^(.{4})(.{4})$", "$1-$2")


def issn_text(value: Column | str) -> Column:
    """``NNNN-NNNC`` of an ISSN however written, the bare letters and digits of anything else, or null."""
    c = as_column(value)
    # ISSNs that are written canonically, nearly all of them, stay inside generated code and take one match.
    return F.when(c.rlike("^[0-9]{4}-[0-9]{3}[0-9X]$"), c).otherwise(issn_dashed(issn_key(c)))


def _checked(k: Column) -> Column:
    weighted = sum(((F.ascii(F.substring(k, i, 1)) - 48) * (9 - i) for i in range(2, 8)), (F.ascii(F.substring(k, 1, 1)) - 48) * 8)
    last = F.substring(k, 8, 1)
    check = F.when(last == "X", F.lit(10)).otherwise(F.ascii(last) - 48)
    return F.coalesce(k.rlike(ISSN_SHAPE) & ((weighted + check) % 11 == 0), F.lit(False))


def issn_key_is_valid(key: Column | str) -> Column:
    """True if the key has the ISSN shape and its check character is right (null counts as false)."""
    return bound(as_column(key), _checked)


def valid_issn(value: Column | str) -> Column:
    """The key of a valid ISSN, else null."""
    return bound(issn_key(value), lambda k: F.when(_checked(k), k))


def issn_status(value: Column | str) -> Column:
    """``missing``, ``invalid_syntax``, ``invalid_checksum`` or ``valid``."""

    def of(k: Column) -> Column:
        return F.when(k.isNull(), "missing").when(~k.rlike(ISSN_SHAPE), "invalid_syntax").when(~_checked(k), "invalid_checksum").otherwise("valid")

    return bound(issn_key(value), of)


def issn_set(values: Column | str) -> Column:
    """Sorted distinct keys of an array of ISSNs; null and blank elements drop, a null array is empty."""
    keys = F.transform(F.coalesce(as_column(values), F.array().cast("array<string>")), issn_key)
    return F.array_sort(F.array_distinct(F.filter(keys, lambda x: x.isNotNull())))
