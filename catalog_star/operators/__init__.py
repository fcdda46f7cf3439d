"""DataFrame operators: cleaning, deduplication, enrichment, keys, star and profiles."""
