"""Operators for preparing training text, and nothing that the rest of the library needs."""
