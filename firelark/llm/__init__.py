"""Operators for building training data: each module holds one operator; queries.py registers them."""
