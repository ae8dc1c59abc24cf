"""Column-valued functions: text, names, vectors."""
