"""Retail basket analytics as Spark DataFrame jobs.

``tables``     the table contracts: schemas, keys and cleaning rules
``functions``  column expressions
``sources``    CSV, Parquet and JSON in and out, shared work folder
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole stages: raw -> bronze -> silver -> gold -> documents

The caller owns the session; nothing here starts, tunes or stops one.
"""


class LarderError(Exception):
    """An input is missing or does not meet its contract."""


# Tables are made anew where this differs from what made them; raise it with their contents.
REVISION = "3"
