"""Composite panels, factors and labels, each a chain of operators."""
