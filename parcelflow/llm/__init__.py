"""Operators of a training-data pipeline: quality, licences, dedup, mixing, tokens, URLs, archives."""
