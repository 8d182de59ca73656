"""Operators for training data of language models. Nothing outside this folder imports it."""
