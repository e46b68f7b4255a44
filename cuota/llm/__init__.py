"""Operators for preparing training data: language, duplicates, archives, tokens, secrets and mixing."""
