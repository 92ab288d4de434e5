"""Readers, writers and nested-record flattening."""
