"""Operators of a training-data pipeline: formatting, cleaning, de-duplication,
tokenising, packing and output of text corpora as Spark jobs.

Nothing outside this subpackage imports it.
"""
