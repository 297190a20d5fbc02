"""Rounding of DOUBLE results the way the reference engine rounds them.

Spark's ``round(double, n)`` rounds the shortest decimal text of the double
half-up (1.025 -> 1.03). The reference rounds the binary value:
``floor(|x| * 10^n + 0.5) / 10^n`` with the sign put back (1.025 -> 1.02,
because 1.025 is stored as 1.02499999...). Ratios and percentages that the
questions return as DOUBLE use this form. Decimals keep ``F.round``
(exact half-up in both engines).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dround(x, n: int = 2) -> Column:
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    p = float(10 ** n)
    return (F.signum(x) * F.floor(F.abs(x) * p + 0.5) / p).cast("double")


def pct(num, den, n: int = 2) -> Column:
    """round(100.0 * num / den, n) as DOUBLE; NULL when den is 0 or NULL."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return dround(F.try_divide(num.cast("double") * 100.0, den.cast("double")), n)
