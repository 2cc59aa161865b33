"""Table sources and the schema contract."""
