"""Column expressions and ordered-group helpers shared by the operators."""
