"""laketide: a PySpark-native daily lakehouse pipeline library.

Every stage is a pure ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` Columns, so Catalyst sees one declarative plan per
job.  Only :mod:`laketide.sinks` writes.  The run date is a
``datetime.date``.  Generic operators take column names; the healthcare
tables of the original pipeline are one configuration of them
(:mod:`laketide.plans`).
"""

__version__ = "0.1.0"
