"""Training-data operators: language, quality, duplicates, contamination, tokens, archives."""
