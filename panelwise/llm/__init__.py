"""Operators of a training-data pipeline: text, token, vector and conversation tables."""
