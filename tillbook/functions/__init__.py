"""Column-level helpers: exact money, days."""
