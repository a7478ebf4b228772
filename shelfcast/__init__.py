"""Retail demand analytics on Spark: profiling, features, models, forecasts, streams."""
