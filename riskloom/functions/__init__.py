"""Column expressions: arithmetic, display, risk rules and hash-based random draws."""
