"""Identifier clean-up and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The characters Unicode-aware text stripping removes.
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(c: Column | str) -> Column:
    """Text of an id without surrounding whitespace; null stays null.

    Nearly all ids are visible ASCII throughout, and seeing that is cheaper than trimming.
    """
    text = _col(c).cast("string")
    trimmed = F.btrim(text, F.lit(WHITESPACE))
    return F.when(text.rlike(r"\A[!-~]*\z"), text).otherwise(trimmed)


def lower_id(c: Column | str) -> Column:
    """Clean id in lower case."""
    return F.lower(clean_id(c))


def zfill(c: Column | str, n: int = 3) -> Column:
    """Pad with zeros to ``n`` characters after any sign; longer text is kept whole."""
    c = _col(c)
    sign = F.regexp_extract(c, r"\A[+-]?", 0)
    digits = F.regexp_replace(c, r"\A[+-]", "")
    # ``lpad`` cuts longer text, so it is never asked for less than there is.
    width = F.greatest(F.length(digits), F.lit(n) - F.length(sign))
    return F.concat(sign, F.lpad(digits, width, F.lit("0")))


def lstrip_zeros(c: Column | str) -> Column:
    """Remove leading zeros; an id made of zeros becomes empty."""
    return F.ltrim(_col(c), F.lit("0"))


def or_empty(c: Column | str) -> Column:
    """Null becomes the empty text."""
    return F.coalesce(_col(c), F.lit(""))


def as_text(c: Column | str) -> Column:
    """Number or other scalar as text."""
    return _col(c).cast("string")


def as_number(c: Column | str, kind: str | T.DataType = "bigint") -> Column:
    """Cast that gives null instead of an error."""
    return _col(c).try_cast(kind)


def sorted_set(c: Column | str) -> Column:
    """Aggregate: the distinct non-null values, sorted."""
    return F.array_sort(F.collect_set(_col(c)))
