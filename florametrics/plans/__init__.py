"""Analyses composed from the operators, one lazy plan each."""
