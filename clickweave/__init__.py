"""clickweave: behaviour-log analytics as plain PySpark DataFrame operators.

Sub-packages:
  sources    text / JSON / TSV scans, hour- and day-range path selection
  operators  parsing, normalisation, click extraction, history, training rows, enrichment
  functions  fixed code tables and column-expression helpers (strings, time, casts)
  sinks      TSV / gzip writers, compaction
  plans      adapters from the driver tables and the registered end-to-end queries
  streaming  the map-only operators run under Structured Streaming
"""

__version__ = "0.1.0"

import sys  # noqa: E402

from pyspark import cloudpickle  # noqa: E402

# functions that run in Python workers are sent by value: the workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
