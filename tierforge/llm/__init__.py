"""Operators for preparing language-model training data, each one module."""
