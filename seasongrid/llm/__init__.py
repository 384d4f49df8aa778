"""Operators for building training data; each module holds one of them."""
