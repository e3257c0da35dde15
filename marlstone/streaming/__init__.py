"""Structured Streaming forms of the window, session, score and drift work."""
