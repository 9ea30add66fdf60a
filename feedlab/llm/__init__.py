"""Operators of a training-data pipeline: duplicates, leaks, personal data, quality, chat, tokens."""
