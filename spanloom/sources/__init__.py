"""Readers and writers of the external layouts."""
