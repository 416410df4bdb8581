"""Readers and writers for cell tables, annotations, metadata documents and results."""
