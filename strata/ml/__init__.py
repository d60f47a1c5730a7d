"""Churn-style classification with Spark ML pipelines."""
