"""Probe-record and session analytics on PySpark.

Subpackages
-----------
functions   column builders (scalar helpers, line parsing, RADIUS JSON, time)
sources     feed layouts and readers
sinks       slice, keyed, cell, CSV and JDBC writers, progress ledgers
operators   joins, KPI aggregates, reports, cells, compaction
plans       the jobs a user runs: ``(inputs, params) -> DataFrame``
streaming   Structured Streaming landing, statistics and offset ledger
"""

import sys

from pyspark import cloudpickle

# Functions handed to tasks travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
