"""Spark-native review-sentiment analytics.

Sub-packages:

* ``sources``   – table scans (Parquet, CSV, JSON lines, prediction store, stream sources)
* ``functions`` – column expressions (text cleaning, labels, probability formatting)
* ``operators`` – DataFrame -> DataFrame operators (prepare, evaluate, features,
  sampling, monitor, tuning)
* ``plans``     – multi-operator jobs (model fit / save / score, report tables)
* ``streaming`` – Structured Streaming parse, score, sink and live aggregates
"""

from sentiscope.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
