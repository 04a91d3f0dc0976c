"""Operators for training data at scale; see ``queries`` for one query each."""
