"""Column expressions: text cleaning, tokenizing, triple parsing, scoring formulas."""
