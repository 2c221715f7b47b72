"""Column expressions: keys, hashes and the calendar."""
