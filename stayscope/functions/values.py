"""Scalar clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blank_to_null(text: Column) -> Column:
    """Null and blank mean the same: missing."""
    return F.nullif(F.trim(text), F.lit(""))


def number_or(text: Column, default: float = 0.0) -> Column:
    """Text to double; blank or unreadable becomes ``default``."""
    return F.coalesce(blank_to_null(text).try_cast("double"), F.lit(float(default)))


def integer_or(text: Column, default: int = 0) -> Column:
    return F.coalesce(blank_to_null(text).try_cast("int"), F.lit(int(default)))


def is_male(gender: Column) -> Column:
    return F.coalesce(F.lower(F.trim(gender)) == "m", F.lit(False))


def contains_ignoring_case(text: Column, part: str) -> Column:
    return F.coalesce(F.lower(text).contains(part.lower()), F.lit(False))


def no_commas(text: Column) -> Column:
    return F.translate(text, ",", ";")


def flatten_field(text: Column) -> Column:
    """One-line form of a quoted field that may hold quotes, commas and line breaks.

    Quotes become spaces, one pass turns double spaces into single ones, blank lines go,
    each remaining line break becomes a space and commas become semicolons.
    """
    spaced = F.replace(F.replace(text, F.lit('"'), F.lit(" ")), F.lit("  "), F.lit(" "))
    packed = F.regexp_replace(spaced, r"\n(?:[ \t\r]*\n)+", "\n")
    return no_commas(F.regexp_replace(packed, r"\r?\n", " "))


def single_spaced(line: Column) -> Column:
    """A raw line with doubled quotes blanked and double spaces halved once."""
    return F.replace(F.replace(line, F.lit('""'), F.lit(" ")), F.lit("  "), F.lit(" "))


def count_quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def no_quoted_commas(record: Column) -> Column:
    """Commas between a pair of quotes become semicolons; the rest stays."""
    return F.array_join(
        F.transform(
            F.split(record, '"'),
            lambda piece, i: F.when(i % 2 == 1, no_commas(piece)).otherwise(piece),
        ),
        '"',
    )
