"""Operators for large text corpora; each module names its method in its docstring."""
