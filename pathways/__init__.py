"""Readiness-indicator pipeline for Spark: DataFrame in, DataFrame out."""
