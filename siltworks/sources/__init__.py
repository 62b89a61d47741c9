"""Reading extracts, and keeping tables."""
