"""Indicator accumulation on Spark.

Finished orders are matched against a table of indicator definitions; every match
adds to one time slice of one indicator, once per order.  The same DataFrame
functions run as a batch backfill and as a Structured Streaming job.
"""
