"""Money conversion: exact half-up rounding to cents.

``round(amount / units_per_usd, 2)`` with decimal division rounds the quotient
to the result scale first and to cents second, which can flip a cent on a
quotient like x.xx4999999995. The rounding here uses whole numbers only:
``cents = (2 * |amount_cents| * 1e8 + R) div (2 * R)`` with ``R = rate * 1e8``,
which is the exact half-up quotient (half away from zero for negatives).
Everything stays a JVM expression inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_usd(amount, units_per_usd, precision: int = 14) -> Column:
    """``amount / units_per_usd`` rounded half-up to cents, as DECIMAL(precision, 2)."""
    a = (_c(amount) * 100).cast("decimal(38,0)")  # exact: amounts carry 2 decimals
    r = (_c(units_per_usd) * 100000000).cast("decimal(38,0)")  # exact: rates carry 8 decimals
    num = (F.abs(a) * 200000000 + r).cast("decimal(38,0)")
    q = F.call_function("div", num, (r * 2).cast("decimal(38,0)"))
    signed = F.when(a < 0, -q).otherwise(q)
    return (signed.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(f"decimal({precision},2)")


def line_net(unit_price, quantity, discount) -> Column:
    """Local net value of an order line: ``unit_price * quantity - discount``."""
    return _c(unit_price) * _c(quantity) - _c(discount)
