"""eventloom: event-collection analytics on PySpark.

Call logs from many devices become enriched event tables (identity as of each
event, context, typed properties, message ids, batches) and delivery-attempt
logs become dispatcher and circuit-breaker reports. Every operator is a
function over DataFrames; see README.md for the map of operators.
"""

__version__ = "0.1.0"
