"""Training-data operators: deduplication, sharding, scoring, filtering, formatting, extraction and encoding of text."""
