"""Operators over change logs, key ranges and resolved timestamps."""
