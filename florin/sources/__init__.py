"""Source tables: contracts, catalog/path readers, sample data derived from the benchmark tables."""
