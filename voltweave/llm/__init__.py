"""Training-data operators: deduplication, scoring, extraction, search, packing."""
