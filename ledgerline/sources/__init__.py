"""Readers of landed data and writers of the stored tables."""
