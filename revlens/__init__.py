"""Product-review analytics on Spark: cleaning, three models, scoring, alerts, reports."""

__version__ = "0.1.0"
