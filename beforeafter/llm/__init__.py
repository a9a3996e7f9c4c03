"""Training-data operators: filters, scores, near duplicates, mixing, sharding, tokens."""
