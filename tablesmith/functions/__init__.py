"""Column expressions and fixed value tables shared by the operators."""
