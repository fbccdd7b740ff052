"""martloom: DataFrame operators and data marts for Spark.

Every operator is a function from DataFrames (or Columns) to DataFrames
(or Columns).  Clocks, watermarks and thresholds are always parameters.
"""
