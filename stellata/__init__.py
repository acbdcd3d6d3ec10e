"""stellata: a Spark-native star-schema warehouse for public-health, climate and
economic data.

Layout
------
functions/  column expressions (cleaning, number parsing, exact rounding, text)
sources/    readers for the raw inputs and the sinks that write results
operators/  reusable DataFrame operators (unpivot, lookups, keys, windows,
            aggregates, data-quality checks, XML/JSON rendering)
plans/      the star schema build, the analytic queries, views and the
            star derived from the benchmark tables
streaming/  the weather-folder ingest run incrementally with Structured Streaming
"""

from stellata.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
