"""Training-data operators: dedup, scoring, formatting, archives, mixing and packing."""
