"""Medallion-layer operators for Apache Spark: plain functions from DataFrame to DataFrame."""
