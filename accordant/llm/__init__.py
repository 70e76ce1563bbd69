"""Operators that clean, deduplicate, score and pack text for training; nothing else here imports them."""
