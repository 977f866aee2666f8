"""Operators that prepare text for model training, with their queries and SQL."""
