"""Readers of files and messages."""
