"""bazaarlake: a retail medallion warehouse written as Spark DataFrame jobs.

``functions``  column expressions (casts, amounts, dates, text)
``operators``  DataFrame to DataFrame building blocks (quality, joins, keys, ...)
``sources``    readers, writers, event sources, the SQL surface
``plans``      layer builds, analytic views, dashboard queries, reports
``streaming``  event parsing, nesting and the idempotent stream sink
"""
