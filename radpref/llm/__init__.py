"""Training-data operators: scanning, filtering, deduplicating, mixing and encoding document tables."""
