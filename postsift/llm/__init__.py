"""Operators for training-data pipelines over large corpora; nothing else in the package imports them."""
