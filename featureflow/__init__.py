"""featureflow: table profiling, feature engineering and regression on Spark.

Subpackages:
  sources    CSV/Parquet readers and writers, schema sidecars, ingest cache
  functions  column expressions (clock, calendar, sentinel, bucketing, lookup)
  operators  table operators: cleaning, joins, statistics, imputation, encoders, sampling
  plans      composite jobs: static features, learned feature stage, model selection, scoring, profile
  streaming  applying a fitted feature stage and model to a stream
"""

__version__ = "0.1.0"
