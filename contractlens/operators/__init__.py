"""Operators over contract tables."""
