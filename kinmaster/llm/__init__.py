"""Operators for preparing training text: ten methods, each in a module of its own."""
