"""Column functions: text, numbers, dates and stock indicators."""
