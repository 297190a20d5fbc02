"""Calendar helpers with boundary-counting semantics.

Spark's ``datediff(MONTH, ..)``/``timestampdiff`` count whole elapsed units;
the questions count calendar boundaries crossed (Jan 31 -> Feb 1 is one
month, 00:00:59 -> 00:01:00 is one minute). These helpers give the boundary
form as plain column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def months_between_boundaries(a, b) -> Column:
    a, b = _c(a), _c(b)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def minutes_between_boundaries(a, b) -> Column:
    a, b = _c(a), _c(b)
    ta = F.unix_seconds(F.date_trunc("minute", a.cast("timestamp")))
    tb = F.unix_seconds(F.date_trunc("minute", b.cast("timestamp")))
    return ((tb - ta) / 60).cast("bigint")


def days_between(a, b) -> Column:
    return F.datediff(_c(b).cast("date"), _c(a).cast("date"))


def epoch_seconds(ts) -> Column:
    """Seconds since epoch of a zone-less UTC timestamp, with microseconds."""
    return F.unix_micros(_c(ts).cast("timestamp")) / 1e6


def date_key(d) -> Column:
    d = _c(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_start(x) -> Column:
    return F.trunc(_c(x).cast("date"), "month")


def iso_dow(d) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(_c(d)) + 1
