"""Relational operators over registers, registries and matches."""
