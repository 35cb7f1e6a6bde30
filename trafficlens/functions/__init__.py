"""Column-level helpers: calendar arithmetic and NULL-aware numerics."""
