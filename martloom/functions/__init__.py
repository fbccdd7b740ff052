"""Column builders; each returns a Column and never touches Python per row."""
