"""Two-decimal rounding that gives the same digits on every engine.

Means are taken over exact decimals with ten places before the final rounding,
so 469/200 rounds half-up to 2.35 whatever the order of the additions.  If any
value is no such decimal (too large, infinite, NaN), the mean is the plain
average of doubles, rounded once: no value is left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,10)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2_sum(c) -> Column:
    return F.round(F.sum(_col(c)), 2)


def exact_avg(c) -> Column:
    """Mean as a decimal; NULL values don't count."""
    return F.avg(_col(c).try_cast(EXACT))


def round2_avg(c) -> Column:
    """round(avg(c), 2) as a double."""
    x = _col(c).cast("double")
    exact = _col(c).try_cast(EXACT)
    return F.when(F.count(exact) == F.count(x), F.round(F.avg(exact), 2).cast("double")).otherwise(F.round(F.avg(x), 2))


def ratio2(num, den) -> Column:
    """round(num / den, 2); NULL when den is 0 or NULL."""
    return F.round(F.try_divide(_col(num).cast("decimal(20,0)"), _col(den)), 2).cast("double")
