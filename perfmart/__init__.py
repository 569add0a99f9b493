"""Daily advertising-performance tables on Spark DataFrames."""
