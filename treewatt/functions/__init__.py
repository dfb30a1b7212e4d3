"""Column helpers and small DataFrame helpers used by the operators."""
