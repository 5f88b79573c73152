"""Operators for training-data pipelines: deduplication, language, toxicity, personal data, tokens, quality."""
