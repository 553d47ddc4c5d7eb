"""Operators for preparing training text at scale (documents, pages, conversations)."""
