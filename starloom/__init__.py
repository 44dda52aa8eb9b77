"""starloom: a star-schema warehouse build and its business queries on Spark.

Raw order tables are cleaned, flagged, winsorized and imputed, woven into one
line-item fact with seven dimensions, written as Parquet and queried.
Every function takes and returns DataFrames; Spark plans and runs the work.
"""
