"""Readers and writers of label formats."""
