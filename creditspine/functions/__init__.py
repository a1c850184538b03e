"""Column builders: each takes columns (or names) and returns a Column."""
