"""Readers: every source ends up as a DataFrame."""
