"""Nightly sleep records and daily health signals as Spark DataFrame operators.

Every operator takes and returns a DataFrame. Timestamps follow one rule:
``timestamp_ntz`` is a local wall time without a zone, ``timestamp`` is an
instant. Missing values are NULL, never NaN.
"""

__version__ = "0.1.0"
