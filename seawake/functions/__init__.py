"""Column expressions: geodesy, time and rules."""
