"""Operators for preparing training data: text, pages and documents."""
