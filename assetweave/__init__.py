"""Asset price analytics as Spark jobs.

sources/    readers, writers, and the tables derived from the driver's parquet
functions/  column expressions (cleaning, rolling indicators, risk rules)
operators/  DataFrame -> DataFrame operators
plans/      multi-step jobs built from the operators
streaming/  Structured Streaming versions of the quote feed
"""
