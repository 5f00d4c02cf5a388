"""Null-safe and zero-safe helpers shared by the plans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs(a: Column, b: Column) -> Column:
    """``IS DISTINCT FROM``."""
    return ~a.eqNullSafe(b)


def any_differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    out = F.lit(False)
    for a, b in pairs:
        out = out | differs(a, b)
    return out


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` in double, NULL for a zero divisor."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def zero_safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` in double, 0 for a missing or zero divisor."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def round2(c: Column) -> Column:
    """Two decimals, halves away from zero.

    Rounding to six decimals first keeps the noise of a distributed float sum, which depends
    on task order, from deciding a tie.
    """
    return F.round(F.round(c.cast("double"), 6), 2)


def zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def gain(deviation: Column) -> Column:
    """Negative part of a signed deviation (NULL counts as 0)."""
    return F.when(deviation <= 0, deviation).otherwise(F.lit(0))


def loss(deviation: Column) -> Column:
    """Positive part of a signed deviation (NULL counts as 0)."""
    return F.when(deviation >= 0, deviation).otherwise(F.lit(0))


def fold(text: Column) -> Column:
    """Case-insensitive, accent-sensitive comparison key; trailing blanks are ignored.

    Joining on this plain string keeps hash and sort-merge joins available.
    """
    return F.lower(F.rtrim(text))


def same_text(text: Column, *options: str) -> Column:
    """Text equals one of the options under :func:`fold`."""
    return fold(text).isin([o.rstrip().lower() for o in options])


def starts_with_text(text: Column, prefix: str) -> Column:
    return fold(text).startswith(prefix.lower())


def label(code: Column, labels: Mapping[object, str]) -> Column:
    """Code to label; NULL for codes that are not listed."""
    out = F.lit(None).cast("string")
    for value, text in reversed(list(labels.items())):
        out = F.when(code == F.lit(value), F.lit(text)).otherwise(out)
    return out


def not_in(c: Column, excluded: Iterable[object]) -> Column:
    """SQL ``NOT IN``: rows with a NULL value do not pass."""
    excluded = list(excluded)
    return ~c.isin(excluded) if excluded else c.isNotNull()


def in_list(c: Column, choices: str | None) -> Column:
    """Optional comma-separated filter: ``None`` lets everything pass."""
    return F.lit(True) if choices is None else c.isin(choices.split(","))


def text_key(*parts: Column) -> Column:
    return F.concat(*[p.cast("string") for p in parts])


def short_md5(*parts: Column) -> Column:
    return F.left(F.md5(text_key(*parts)), F.lit(8))
