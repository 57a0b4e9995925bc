"""Data preparation and model evaluation as lazy PySpark DataFrame functions."""

__version__ = "0.1.0"
