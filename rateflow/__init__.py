"""Batch analytics over financial time series, expressed as Spark plans."""
