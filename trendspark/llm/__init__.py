"""Operators for building and cleaning training corpora for language models."""
