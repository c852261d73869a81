"""Operators of a training-data pipeline over texts, vectors and archives."""
