"""Operators for the text of training corpora. Nothing else in the library imports this."""
