"""Operators on training text: one module each, their queries in ``registered``."""
