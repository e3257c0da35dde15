"""Splits, cleaning, feature transforms, profiles."""
