"""Preparing training text: encoding, language, quality, toxicity, duplicates and packing."""
