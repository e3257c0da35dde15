"""Evaluation tables for predictions, rankings and clusters."""
