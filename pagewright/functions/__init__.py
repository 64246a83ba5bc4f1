"""Column functions and the pattern catalogue."""
