"""Operators for training-data pipelines over text, conversations and vectors. Nothing else in the library imports them."""
