"""Training-data operators: mixing, deduplication, extraction, tokens, decontamination, search, toxicity, quality, privacy."""
