"""Observation lake on Spark: station observations from raw files to reports."""
