"""Training-data operators: reading archives, filtering, deduplicating, mixing and packing text."""
