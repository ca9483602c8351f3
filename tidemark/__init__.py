"""Warehouse loading, modelling and data-quality jobs as Spark DataFrame code."""

__version__ = "0.1.0"
