"""Fraud analytics for instant-payment transactions, as Spark jobs.

* ``schema``     record layouts and rule parameters
* ``functions``  column expressions: contract checks, clean-up, time, exact median
* ``sources``    where frames come from: tables, topics, databases
* ``operators``  DataFrame -> DataFrame: parsing, profile, rules, alerts, reports
* ``plans``      whole detection run, and the registered queries with their SQL
* ``streaming``  ingest and detection on Structured Streaming
"""
