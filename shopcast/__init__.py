"""shopcast: daily retail sales analytics and forecasting on Spark.

Every public function takes and returns DataFrames, so Catalyst plans the
whole job and the same code runs on a laptop or on a cluster.

Sub-packages
------------
sources    read the fact and dimension tables, CSV / Parquet / views
sinks      write tables, feature lists, models and forecasts
functions  column expressions: calendar parts, exact money rounding, bands
operators  cleaning, profiling, features, scoring, forecasting, training
plans      the business reports and the query catalogue
streaming  the anomaly stream (file source -> foreachBatch -> Parquet)
"""

__version__ = "0.1.0"
