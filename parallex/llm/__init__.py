"""Training-data operators: dedup, decontamination, quality, extraction, scoring, mixing, sharding."""
