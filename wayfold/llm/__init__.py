"""Operators of a training-data pipeline: cleaning, de-duplication, scoring, formatting and mixing of text."""
