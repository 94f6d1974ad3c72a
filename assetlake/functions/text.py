"""Plain text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_space(text: Column) -> Column:
    """Text without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def text_or_empty(text: Column) -> Column:
    """Trimmed text, '' for NULL."""
    return F.coalesce(strip_space(text), F.lit(""))


def join_pairs(pairs: Column, name: str, value: str, separator: str = "; ") -> Column:
    """``name: value`` of every struct in an array, joined to one text."""
    return F.array_join(
        F.transform(
            pairs,
            lambda p: F.concat(
                F.coalesce(p[name], F.lit("")), F.lit(": "), F.coalesce(p[value], F.lit(""))
            ),
        ),
        separator,
    )


def join_texts(texts: Column, separator: str = ", ") -> Column:
    """Trimmed texts of an array joined to one; NULL elements are left out."""
    return F.coalesce(F.array_join(F.transform(texts, strip_space), separator), F.lit(""))


def clean_name(name: str) -> str:
    """Sheet header as a column name: blanks to ``_``, dots and round brackets removed."""
    return name.translate(str.maketrans(" ", "_", ".()"))
