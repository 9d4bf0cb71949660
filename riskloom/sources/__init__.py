"""Readers, writers and option sets for files, message topics and databases."""
