"""Keyword-trend analytics and training-data preparation on Spark."""
