"""Schema-time functions and column expressions."""
