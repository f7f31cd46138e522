"""Operators that prepare text for training language models, each by a method of its own."""
