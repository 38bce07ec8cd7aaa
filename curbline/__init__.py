"""Spatial feature engineering and regression on street networks, as PySpark DataFrame code."""
