"""Column-level helpers: all built from pyspark.sql.functions (JVM side)."""

from bazaar.functions.lenient import (  # noqa: F401
    event_time, lenient_date, lenient_double, lenient_int, normalize_event_date,
)
from bazaar.functions.ladders import classify  # noqa: F401
from bazaar.functions.rounding import round2_avg, round2_sum, ratio2  # noqa: F401
