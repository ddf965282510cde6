"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  ``queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five of
them.
"""
