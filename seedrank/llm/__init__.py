"""Training-data operators: quality, language, deduplication, scoring, packing, filtering."""
