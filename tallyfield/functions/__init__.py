"""Column expressions: tolerant parsing, labels and key hashing."""
