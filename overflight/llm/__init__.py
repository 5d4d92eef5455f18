"""Operators on text corpora for training data. Nothing outside this folder imports them."""
