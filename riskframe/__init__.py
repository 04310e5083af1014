"""riskframe: credit-risk tables, models and streams as Spark jobs."""

__version__ = "0.1.0"
