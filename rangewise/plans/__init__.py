"""Composite jobs: the star schema, the monthly refresh, analyst reports."""
