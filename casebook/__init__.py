"""casebook: support-ticket analytics as Spark DataFrame jobs.

Sub-packages
------------
functions  Column -> Column expressions (labels, flags, links, buckets).
sources    Readers: driver tables, JSON document tables, text logs, paged feeds.
operators  DataFrame -> DataFrame operators (silver, threads, merge, write-back ...).
plans      The query catalogue run by the driver and its SQL oracles.
streaming  Structured Streaming twins of the batch operators.
"""

from casebook.config import Settings, FIXTURE_SETTINGS

__all__ = ["Settings", "FIXTURE_SETTINGS"]
