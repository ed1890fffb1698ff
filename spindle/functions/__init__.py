"""Column-level functions (pure expressions; no Python UDFs)."""
