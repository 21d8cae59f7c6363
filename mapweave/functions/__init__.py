"""Column helpers: declared casts, rule expressions, person names, choice lists."""
