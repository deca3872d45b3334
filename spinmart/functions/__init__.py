"""Column-level rules: time, windows, text and JSON."""
