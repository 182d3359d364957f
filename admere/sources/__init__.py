"""Readers of delivered files and writers of tables."""
