"""Daily retail panels on Spark: ingest, features, checks, models, scores, anomalies, sequences."""
