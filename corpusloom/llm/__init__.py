"""Operators for the texts of training data.  Nothing else in the library imports this subpackage."""
