"""Column helpers shared by every operator.

* ``fdiv``: IEEE-754 float division (x/0 = +-inf, 0/0 = NaN, null propagates).
  Spark 4 runs with ANSI on, where ``a / b`` raises DIVIDE_BY_ZERO and
  ``try_divide`` returns NULL; neither is what a float pipeline means.
* ``rolling``: a trailing window aggregate that is NULL until the frame holds
  ``n`` non-null values (the "full window" rule every indicator uses).
* ``finite_or_null`` / ``out``: map NaN and +-inf to NULL and round, used only
  when presenting results for comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def fdiv(numerator: Column | float, denominator: Column | float) -> Column:
    """IEEE float division that survives ANSI mode.

    When the denominator is zero the quotient is ``n * d**-1``; Java's
    ``pow(+-0.0, -1.0)`` is ``+-inf`` so the sign and the NaN of ``0/0`` come
    out as in IEEE arithmetic.  The ``otherwise`` branch is only evaluated for
    non-zero denominators.
    """
    n = numerator if isinstance(numerator, Column) else F.lit(float(numerator))
    d = denominator if isinstance(denominator, Column) else F.lit(float(denominator))
    n = n.cast("double")
    d = d.cast("double")
    return F.when(d == 0, n * F.pow(d, F.lit(-1.0))).otherwise(n / d)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """Frame of the current row and the ``n - 1`` rows before it."""
    return w.rowsBetween(-(n - 1), 0)


def rolling(agg: Callable[[Column], Column], col: Column, w: WindowSpec, n: int) -> Column:
    """``agg(col)`` over the trailing ``n`` rows, NULL unless all ``n`` are non-null."""
    frame = trailing(w, n)
    return F.when(F.count(col).over(frame) >= n, agg(col).over(frame))


def finite_or_null(col: Column) -> Column:
    """NaN and +-inf become NULL (NULL stays NULL)."""
    c = col.cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def out(col: Column, digits: int = 6) -> Column:
    """Presentation form of a float: finite values rounded, the rest NULL.

    Rounds the binary value ``x * 10**digits`` half away from zero, so a
    double just below a decimal half-way point rounds down (``F.round(x, d)``
    would round the shortest decimal string instead).
    """
    scale = F.lit(float(10 ** digits))
    return F.round(finite_or_null(col) * scale, 0) / scale + F.lit(0.0)  # no negative zero
