"""Training-data operators: quality, duplicates, extraction, language model, sharding, mixing, packing."""
