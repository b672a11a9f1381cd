"""Readers and writers of every table that crosses a file boundary."""
