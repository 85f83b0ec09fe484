"""Whole cycles and read queries, composed from the operators."""
