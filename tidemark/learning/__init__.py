"""Churn classification on Spark ML."""
