"""Reusable relational operators."""
