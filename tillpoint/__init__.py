"""tillpoint: retail data preparation and analytics as Spark DataFrame plans.

Layout
------
sources/    table readers, the retail views over the TPC-H-style tables, file sources and sinks
functions/  shared column expressions (revenue, money rounding, title case, date parsing)
operators/  profiling, cleaning, data-quality rules, global windows, top-k, keyed upsert
plans/      the report queries and their independent SQL oracles
streaming/  incremental micro-batch upserts on Structured Streaming
"""

from tillpoint.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
