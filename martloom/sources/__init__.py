"""Readers.  All schemas are explicit unless a reader says otherwise."""
