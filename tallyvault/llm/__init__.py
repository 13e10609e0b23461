"""Training-data operators: dedup, filters, decontamination, tokens, extraction."""
