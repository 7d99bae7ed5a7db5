"""Column expressions: cleaning, geography, opening hours, text."""
