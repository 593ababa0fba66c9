"""Operators that need a plan of their own rather than one expression."""
