"""Scalar numeric helpers.

All helpers return native ``Column`` expressions so they stay inside
whole-stage codegen.  Rounding is always ``rint``-based (round half to
even on the scaled value), which is what numpy's ``ndarray.round`` and
Python's ``round`` to an integer do; Spark's ``round``/``bround`` give
different answers on ties (SURVEY N1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col_(c: ColumnOrName | float | int) -> Column:
    """Accept a Column, a column name or a Python number."""
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(float(c)) if isinstance(c, float) else F.lit(c)


def dbl(x: float | int) -> Column:
    """A DOUBLE literal (a bare ``0.8`` in SQL is DECIMAL, SURVEY N2)."""
    return F.lit(float(x))


def clip(x: ColumnOrName, lo, hi) -> Column:
    """``least(greatest(x, lo), hi)``."""
    return F.least(F.greatest(col_(x), col_(lo)), col_(hi))


def pos(x: ColumnOrName) -> Column:
    """``max(0, x)``."""
    return F.greatest(dbl(0.0), col_(x))


def r0(x: ColumnOrName) -> Column:
    """round half to even to an integer."""
    return F.rint(col_(x)).cast("int")


def rnd(x: ColumnOrName, places: int) -> Column:
    """``rint(x * 10^n) / 10^n``."""
    scale = float(10 ** places)
    return F.rint(col_(x) * F.lit(scale)) / F.lit(scale)


def r1(x: ColumnOrName) -> Column:
    return rnd(x, 1)


def r2(x: ColumnOrName) -> Column:
    return rnd(x, 2)




def band(x: ColumnOrName, hi, lo, *, higher_is_worse: bool = True,
         inclusive: bool = False, labels=("danger", "warn", "safe")) -> Column:
    """Three-way severity band.

    ``higher_is_worse``: ``x > hi`` -> labels[0], ``x > lo`` -> labels[1].
    Otherwise (lead time): ``x <= hi`` -> labels[0], ``x <= lo`` -> labels[1].
    ``inclusive`` switches ``>`` to ``>=`` for the higher-is-worse form.
    """
    c = col_(x)
    hi_c, lo_c = col_(hi), col_(lo)
    if higher_is_worse:
        first = (c >= hi_c) if inclusive else (c > hi_c)
        second = (c >= lo_c) if inclusive else (c > lo_c)
    else:
        first, second = c <= hi_c, c <= lo_c
    return (F.when(first, F.lit(labels[0]))
            .when(second, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))
