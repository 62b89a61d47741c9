"""Column expressions: safe casts, text clean-up, order measures."""
