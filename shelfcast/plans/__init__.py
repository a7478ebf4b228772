"""Composed jobs: feature build, clustering, model training, forecasts."""
