"""Reading input tables and writing feature tables."""
