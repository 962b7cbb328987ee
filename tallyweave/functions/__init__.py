"""Column formulas shared by the operators."""
