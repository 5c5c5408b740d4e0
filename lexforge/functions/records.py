"""Fields of text records: dictionary lines and decomposition lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions.symbols import KANJI, strip


def headword(line: Column) -> Column:
    """Text before the first ``/`` and before the first ``[``."""
    return strip(F.regexp_extract(line, r"^([^/\[]*)", 1))


def bracket_reading(line: Column) -> Column:
    """The ``[reading]`` that follows the headword; null where there is none."""
    return F.nullif(strip(F.regexp_extract(line, r"^[^/\[]*\[([^\]/]*)\]", 1)), F.lit(""))


def glosses(line: Column) -> Column:
    """``/``-separated glosses after the head, without non-empty parenthesised groups and blanks.

    Groups end at the first closing parenthesis, so they do not nest.
    """
    parts = F.split(line, "/")
    clean = F.transform(
        F.slice(parts, F.lit(2), F.size(parts)),
        lambda g: strip(F.regexp_replace(g, r"\([^)]+\)", "")),
    )
    return F.filter(clean, lambda g: g != "")


def is_decomposition(line: Column, symbol: str = KANJI) -> Column:
    """The line starts with one symbol and a colon."""
    return line.rlike(f"^{symbol}:")


def decomposition(line: Column, with_parts: bool = False) -> Column:
    """``X:role(a,b)`` -> (kanji, role, phonetics = first part, meaning = last part).

    The role ends at the last opening parenthesis; the parts come from the last non-empty group.
    Null parts where there is no group. ``with_parts`` keeps all parts beside the two.
    """
    inner = F.nullif(F.regexp_extract(line, r"^.*\(([^)]+)\)", 1), F.lit(""))
    parts = F.split(F.rtrim(inner, F.lit(",")), ",")
    fields = [
        F.substring(line, 1, 1).alias("kanji"),
        F.regexp_extract(line, r":(.*)\(", 1).alias("role"),
        F.get(parts, F.lit(0)).alias("phonetics"),
        F.element_at(parts, -1).alias("meaning"),
    ]
    return F.struct(*fields, parts.alias("parts")) if with_parts else F.struct(*fields)
