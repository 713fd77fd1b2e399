"""Operators: functions from DataFrame to DataFrame, or to a ``pyspark.ml`` model."""
