"""Operators for building training data; nothing outside this folder imports them."""
