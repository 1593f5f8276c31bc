"""Column expressions (no shuffles) and per-sequence feature vectors."""
