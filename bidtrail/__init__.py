"""Bid-log analytics on Spark: parse, enrich, derive user features, score, serve."""
