"""Readers: every one returns a lazy DataFrame with a declared schema."""
