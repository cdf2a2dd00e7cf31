"""Operators of a training-data pipeline over ``documents``, ``embeddings`` and ``pages``.

Each module holds one operator; ``queries`` applies them to whole tables. Nothing else in the library imports this package.
"""
