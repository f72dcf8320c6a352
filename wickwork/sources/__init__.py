"""Readers and message decoding."""
