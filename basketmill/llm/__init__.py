"""Operators for training-data pipelines: text, tokens, labels, fingerprints and vectors."""
