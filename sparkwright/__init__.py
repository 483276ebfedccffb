"""sparkwright: customer, sales and feed analytics as Spark DataFrame jobs.

Sub-packages:

* ``sources``   – readers for CSV / parquet inputs and the fixture views
* ``functions`` – Column-level building blocks (user-agent rules, date tests, paths)
* ``operators`` – DataFrame -> DataFrame operators (approvals, clickstream, sales, feed,
  quality, ranking, tuning)
* ``sinks``     – append and keyed-merge writers over versioned parquet tables
* ``streaming`` – file-arrival ingestion with Structured Streaming
* ``plans``     – the query catalogue and its SQL oracle
"""

from sparkwright.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
