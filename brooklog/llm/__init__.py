"""Operators on text corpora: deduplication, decontamination, tokens, shards.

Nothing outside this package imports it, except the driver's entry file and the
pipeline file at the top of the repository.
"""
