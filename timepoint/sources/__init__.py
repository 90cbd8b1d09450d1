"""Readers, writers and feed decoders."""
