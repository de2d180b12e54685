"""Training-data operators on Spark: quality, sharding, PII, dedup, tokenising, mixing, classifiers."""
