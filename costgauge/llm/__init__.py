"""Operators for preparing training data: documents, pages, conversations and embeddings at corpus scale."""
