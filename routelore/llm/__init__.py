"""Training-data operators: dedup, decontamination, quality, sharding, extraction and mixing."""
