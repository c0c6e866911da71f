"""Batch analytics over per-district weather and air-quality observations, on Spark."""

__version__ = "0.1.0"
