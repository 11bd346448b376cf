"""Operators for preparing large model training data. Nothing else in the library imports this package."""
