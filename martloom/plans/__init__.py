"""Data marts composed from the operators."""
