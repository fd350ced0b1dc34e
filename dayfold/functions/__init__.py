"""Column helpers and the skew helper shared by the operators."""
