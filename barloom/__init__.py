"""Price-bar analytics on Spark: bars, indicators, labels, features, models."""
