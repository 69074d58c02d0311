"""chronoledger: a Spark-native engine for incremental metric-history tables.

Every operator is a DataFrame-in / DataFrame-out function built on the public
PySpark DataFrame and SQL API. Sub-packages:

* ``sources``   – table store (versioned parquet), schema conformance, stand-ins
* ``operators`` – merges, dedupe, due-queue, outcome roll-ups, time series
* ``functions`` – column-level helpers (JSON, error classes, time arithmetic)
* ``plans``     – served datasets, run-level compositions, query registry
* ``streaming`` – micro-batch execution of the ingest steps over the raw table
"""

__version__ = "0.1.0"
