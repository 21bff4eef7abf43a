"""Operators of a training-data pipeline: classification, retrieval, packing,
token files, deduplication and mixing over ``documents`` and ``embeddings``.

Nothing else in the package imports this subpackage.
"""
