"""Operators for training-data pipelines over documents, pages, labels, benchmark items and embeddings."""
