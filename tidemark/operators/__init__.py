"""Operators: (DataFrame, column names, parameters) -> DataFrame."""
