"""Column helpers on arrays and numbers."""
