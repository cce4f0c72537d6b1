"""Micro-batch execution of the matching plan."""
