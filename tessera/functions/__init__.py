"""Column functions for names, texts and values."""
