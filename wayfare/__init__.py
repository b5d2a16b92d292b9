"""Trip analytics on Spark: layered clean-up, marts and reports."""

__version__ = "0.1.0"
