"""Column expressions and grouped helpers shared by the operators."""
