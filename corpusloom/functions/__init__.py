"""Column expressions: text, vectors, paths and licences."""
