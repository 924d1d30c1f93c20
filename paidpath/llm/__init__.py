"""Operators of a training-data pipeline: tokenising, language identification, language
model scoring, vector search, near-duplicate joins, WARC, repeated passages, quality,
decontamination and sharding. Nothing outside this package imports it."""
