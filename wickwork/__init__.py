"""Candlestick analytics on PySpark: ingest, features, quality, models, streams."""
