"""Training-data operators: scoring, deduplication, decontamination, packing."""
