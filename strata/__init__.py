"""strata: Spark-native medallion analytics over repeatedly observed entities.

Layers land JSON observations (batch or Structured Streaming), clean them into a
history table and a current-state table, and expose DataFrame operators on top:
distributions, top-N, term frequencies, change/velocity and trend detection,
anomaly and risk scores, time-proximity joins and versioned snapshot tables.

Every operator is ``DataFrame -> DataFrame``. Actions happen in sinks, layer
runs and tests, plus two bounded steps of the skew-proof ordered scan (a hot-key
list of fewer than ``P`` keys, and the checkpoint that pins its range slices).
"""

from strata.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
