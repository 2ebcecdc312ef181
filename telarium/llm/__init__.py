"""Operators for training text; nothing else in telarium imports this subpackage."""
