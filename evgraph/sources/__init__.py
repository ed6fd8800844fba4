"""Readers, writers and adapters of source records."""
