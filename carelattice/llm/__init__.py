"""Operators for preparing training text, each usable on its own; the rest of the library does not need them."""
