"""Jobs: read stored tables, apply operators, store the result."""
