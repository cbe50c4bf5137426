"""Operators for preparing language-model training text (see the README)."""
