"""Row predicates P1-P10 as reusable ``Column`` builders.

All date bounds are computed on the driver from the typed ``as_of`` date, so they reach
the parquet scan as literals (PushedFilters) instead of per-row date arithmetic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import OrRule


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_before(as_of: dt.date, days: int) -> dt.date:
    """``as_of - days``."""
    return as_of - dt.timedelta(days=days)


def closed_window(c, as_of: dt.date, days: int) -> Column:
    """``c >= as_of - days and c <= as_of``.

    For a timestamp column the date bounds mean midnight, so the ``as_of`` day itself is
    excluded except for events at exactly 00:00:00 (semantics note 1)."""
    c = _col(c)
    return (c >= F.lit(days_before(as_of, days))) & (c <= F.lit(as_of))


def on_day(c, day: dt.date) -> Column:
    """Snapshot equality."""
    return _col(c) == F.lit(day)


def since(c, day: dt.date) -> Column:
    """Open-ended ``c >= day``."""
    return _col(c) >= F.lit(day)


def contains_ci(c, pattern: str) -> Column:
    """P5: ``c ilike pattern`` (null stays null, so the row is dropped by a filter)."""
    return _col(c).ilike(pattern)


def not_contains_ci(c, pattern: str) -> Column:
    """``c not ilike pattern``; a null value is dropped, as in SQL."""
    return ~_col(c).ilike(pattern)


def is_true(c) -> Column:
    """``c = true``; null is dropped."""
    return _col(c) == F.lit(True)


def is_false(c) -> Column:
    """``c = false``; null is dropped."""
    return _col(c) == F.lit(False)


def false_or_null(c) -> Column:
    """``not c or c is null``."""
    return ~F.coalesce(_col(c), F.lit(False))


def or_rule(rule: OrRule, cat="cat_id", tx="tx_type", subtype="subtype") -> Column:
    """P10: ``cat = a or (cat = b and tx = t) or subtype ilike p``."""
    cat, tx, subtype = _col(cat), _col(tx), _col(subtype)
    return (
        (cat == F.lit(rule.main_cat_id))
        | ((cat == F.lit(rule.second_cat_id)) & (tx == F.lit(rule.second_tx_type)))
        | subtype.ilike(rule.subtype_pattern)
    )
