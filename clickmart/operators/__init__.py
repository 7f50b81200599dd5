"""Reusable relational operators: clean, sessions, ranking, geo join, similarity."""
