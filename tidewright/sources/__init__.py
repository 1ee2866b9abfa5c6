"""Readers and writers of the file formats, and source selection."""
