"""Batch reports and monthly fact tables as plain PySpark DataFrame plans."""
