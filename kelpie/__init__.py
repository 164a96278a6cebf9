"""kelpie: stream-to-model analytics expressed as Spark DataFrame, SQL and
Structured Streaming jobs.

Sub-packages
------------
sources    topic tables, control records, files, weight tables
functions  column-level codecs and feature expressions
operators  splits, filters, joins, aggregations, windows, training, serving,
           federated algebra and reward accounting
streaming  micro-batch and stateful versions of the above
plans      fixture mappings from the driver tables and the query catalogue
"""

__version__ = "0.1.0"
