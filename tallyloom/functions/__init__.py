"""Column expressions: text, numbers, hashes and derived features."""
