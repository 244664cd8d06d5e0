"""Text, list and number cleaning expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Name = str | Column


def _c(col: Name) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_prefix(col: Name, width: int = 2) -> Column:
    """Id text without its leading marker, as a number (null when not numeric)."""
    return F.substr(_c(col), F.lit(width + 1)).try_cast("bigint")


def drop_markers(col: Name, *markers: str) -> Column:
    """Remove every occurrence of each marker."""
    out = _c(col)
    for marker in markers:
        out = F.replace(out, F.lit(marker), F.lit(""))
    return out


def id_number(col: Name, *markers: str) -> Column:
    return drop_markers(col, *markers).try_cast("bigint")


def keep_digits(col: Name) -> Column:
    """Digits and commas only."""
    return F.regexp_replace(_c(col), "[^0-9,]", "")


def strip_chars(col: Name, chars: str = '[]"') -> Column:
    return F.translate(_c(col), chars, "")


def split_list(col: Name, sep: str = ",") -> Column:
    return F.split(_c(col), sep)


def split_name(col: Name) -> tuple[Column, Column]:
    """First word and the rest; no blank means no last name."""
    parts = F.split(_c(col), " ", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def fixed_slots(col: Name, names: Sequence[str]) -> list[Column]:
    """A comma list spread over a fixed number of columns, missing slots null."""
    parts = split_list(col)
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]


def to_number(col: Name) -> Column:
    """Text to nullable whole number; anything unreadable is null."""
    return _c(col).try_cast("double").try_cast("bigint")


def null_if_blank(col: Name) -> Column:
    """One null for every spelling of it."""
    c = _c(col)
    return F.when(c.isin("", "\\N", "None"), F.lit(None)).otherwise(c)


def upper_list(col: Name) -> Column:
    return F.transform(_c(col), F.upper)


def drop_second_acting_entry(jobs: Column, marker: str = "ACT") -> Column:
    """With exactly two acting entries, remove the one listed last."""
    acting = F.filter(jobs, lambda j: j.contains(marker))
    doomed = F.array_position(jobs, F.element_at(acting, -1)) - 1
    trimmed = F.filter(jobs, lambda j, i: i != doomed)
    return F.when(F.size(acting) == 2, trimmed).otherwise(jobs)


def exact_match(col: str, routes: dict[str, tuple[str, ...]]) -> Column:
    """The route whose values hold the cell; null if none does."""
    out = F.lit(None).cast("string")
    for name, accepted in routes.items():
        out = F.when(F.col(col).isin(*accepted), F.lit(name)).otherwise(out)
    return out


def first_match(col: Name, routes: Sequence[tuple[str, str]]) -> Column:
    """Target of the first route whose marker occurs in the upper-cased text."""
    text = F.upper(_c(col))
    out = F.lit(None).cast("string")
    for marker, target in reversed(list(routes)):
        out = F.when(text.contains(marker), F.lit(target)).otherwise(out)
    return out
