"""Rounding to two digits on integers, halves away from zero.

Engines differ when they round doubles, so the ratio is rounded as a whole number of hundredths.
Arguments are SQL expressions of integer type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hundredths(scaled: str, parts: str) -> Column:
    """scaled / parts in hundredths, where scaled already carries the factor 200; NULL when parts is 0.

    div cuts towards zero, so the half is added away from it.
    """
    return F.expr(f"cast(({scaled} + if({scaled} < 0, -1L, 1L) * ({parts})) div nullif(2 * ({parts}), 0L) AS double) / 100.0D")


def percent(part: str, total: str) -> Column:
    """100 * part / total, rounded to 2 digits, for 0 <= part <= total."""
    return _hundredths(f"20000 * ({part})", total)


def mean(total: str, n: str) -> Column:
    """total / n rounded to 2 digits."""
    return _hundredths(f"200 * ({total})", n)
