"""Readers and writers of the file formats, and staging of intermediate tables."""
