"""Reading extracts and tables, writing tables."""
