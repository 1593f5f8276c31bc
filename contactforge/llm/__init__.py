"""Operators of a training-data pipeline: formatting, tokens, near copies, quality, language, sharding, search."""
