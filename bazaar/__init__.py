"""bazaar: retail lakehouse analytics (bronze -> silver -> gold -> features,
forecast and recommendations) written with the public PySpark DataFrame,
Structured Streaming and Spark ML APIs.

Layout
------
functions/  column-level helpers (lenient casts, ladders, money rounding)
sources/    readers: driver test tables, layer tables, stream sources
operators/  DataFrame -> DataFrame operators (bronze, silver, gold, serving,
            roll-ups, time-series features, journey, quality)
plans/      composed batch jobs (medallion build, feature table, forecast,
            recommendations)
streaming/  stream sources/sinks and the same operators run incrementally
"""

__version__ = "0.1.0"
