"""Training-data operators: deduplication, scoring, classification, mixing, tokenization, archives."""
