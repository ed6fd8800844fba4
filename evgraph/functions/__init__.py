"""Column expressions: names, identifiers, authors, dates, URLs and JSON."""
