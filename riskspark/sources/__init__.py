"""Readers, writers and the contracts they check."""
