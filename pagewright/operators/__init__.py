"""Stages over documents, pages and lines."""
