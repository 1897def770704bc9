"""Column expressions: exact rounding, text normalisation, date parsing."""
