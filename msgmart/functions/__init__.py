"""Column functions: time parsing, JSON text and maps."""
