"""Column-level functions: periods, formatting, rate algebra."""
