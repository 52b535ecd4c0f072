"""Column expressions: parsing, rounding, masking and text helpers."""
