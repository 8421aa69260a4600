"""Operators over text corpora, web pages and embeddings. Nothing else in the library imports this subpackage."""
