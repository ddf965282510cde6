"""Composed plans: the whole pipelines and the registered query catalog."""
