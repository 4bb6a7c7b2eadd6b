"""Operators: DataFrame functions and ``pyspark.ml`` estimators and models."""
