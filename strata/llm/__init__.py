"""Training-data operators: deduplication, search, filtering, tokenising, scoring, extraction, decontamination."""
