"""Training-data operators: dedup, scoring, scanning, mixing, formatting and tokenization."""
