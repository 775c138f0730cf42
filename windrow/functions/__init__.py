"""Column expressions: hashes, vectors, scores and text."""
