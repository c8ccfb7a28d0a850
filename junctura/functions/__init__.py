"""Column expressions and vectorised numeric functions."""
