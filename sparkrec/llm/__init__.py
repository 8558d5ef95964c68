"""Training-data operators: tokenising, fingerprints, deduplication, scoring and mixing on Spark."""
