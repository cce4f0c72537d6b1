"""Compositions of operators and the driver's queries."""
