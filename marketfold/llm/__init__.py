"""Operators for preparing training text: tokens, personal data, quality, duplicates and leaks."""
