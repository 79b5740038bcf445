"""Column-expression building blocks (geometry, text)."""
