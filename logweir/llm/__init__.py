"""Training-data operators: scans, scores, extraction, deduplication, mixing, tokens, search."""
