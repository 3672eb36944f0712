"""Column expressions: no action, no state."""
