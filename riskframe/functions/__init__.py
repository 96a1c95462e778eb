"""Column expressions and column-set operators."""
