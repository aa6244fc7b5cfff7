"""Row operators: validation, routing, lookups, dedup, sequencing."""
