"""Readers for text files, tables and message streams."""
