"""Behavioural analytics on Spark: features, labels, segments and scores from a product event log."""
