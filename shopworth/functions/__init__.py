"""Column expressions: special functions and the two purchase models."""
