"""Column-level text functions, the Porter stemmer and the stop-word list."""
