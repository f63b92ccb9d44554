"""Operators of a training-data pipeline over a table of documents.

Nothing else in the library imports this subpackage. Texts are cut into words
inside Arrow batches; everything that meets other documents is a shuffle,
a join or an aggregate of DataFrames.
"""
