"""Operators for preparing training text, each on tables of documents, pages or benchmark items."""
