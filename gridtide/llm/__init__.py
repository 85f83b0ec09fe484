"""Operators that prepare text for model training, apart from the rest of the library."""
