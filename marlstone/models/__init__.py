"""Model fitting and scoring, on plain aggregates or MLlib."""
