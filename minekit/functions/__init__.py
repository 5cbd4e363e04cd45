"""Column expressions, skew-safe joins and shared storage."""
