"""Column expressions, fixed code tables and ranking helpers."""
