"""Composed jobs: the full pipeline and the registered queries."""
