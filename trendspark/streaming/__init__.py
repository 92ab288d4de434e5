"""Resumable collection."""
