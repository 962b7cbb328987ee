"""Readers, writers and whole-dataset steps."""
