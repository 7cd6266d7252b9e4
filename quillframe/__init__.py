"""Document analytics on Spark: ordered block classification, grouping, attribution and reconciliation."""

__version__ = "0.1.0"
