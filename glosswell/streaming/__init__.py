"""The same questions on live streams.

Counting and summing are the table plans themselves, run on a watermarked stream in append mode.
This package adds what needs state of its own: the author record, running scores and bounded
rankings, all keyed state kept by Spark.
"""
