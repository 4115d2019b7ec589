"""Retail order analytics expressed as Spark DataFrame jobs.

Packages
--------
functions   Column helpers: ratios, months, intervals, text formats.
sources     Table schemas, CSV in and out, file layouts, canonical views.
operators   Reusable jobs: global ranking, percentiles, quality, constraints,
            inventory.
plans       The business reports and the monthly mart.
streaming   Structured Streaming forms of the ledger and the monthly totals.
llm         Operators of a training-data pipeline; nothing else imports it.
"""
