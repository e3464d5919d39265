"""basketry: retail customer analytics expressed as Spark DataFrame plans.

Layers
------
sources    canonical schemas, driver-table views, CSV/JSON readers and writers
functions  column expressions (calendar keys, whole-day durations, null-safe flags, text)
operators  reusable DataFrame operators (keep-first dedup, exact quantiles, argmax, ...)
plans      the composite results: clean tables, features, trends, segments, insights
streaming  the same trend plans driven by Structured Streaming
"""

from basketry.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
