"""Business analytics operators for PySpark: DataFrames in, DataFrames out."""

from tallywork.api import Analytics

__all__ = ["Analytics"]
