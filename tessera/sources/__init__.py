"""Readers, writers, snapshots and configuration."""
