"""Training-data operators: sharding, deduplication, packing, counting, scanning and search."""
