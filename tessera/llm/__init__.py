"""Training-data pipeline operators: dedup, fingerprints, classifiers, packing, mixing, PII."""
