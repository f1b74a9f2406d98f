"""Composed batch jobs built from the operators."""
