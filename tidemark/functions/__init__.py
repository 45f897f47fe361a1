"""Column-level helpers: names, marks, audit values and physical types."""
