"""Operators of a training-data pipeline: filtering, extraction, deduplication, mixing.

Nothing else in the package imports this folder.
"""
