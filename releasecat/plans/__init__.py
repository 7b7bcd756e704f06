"""Whole jobs: export, transform, summary, transfer and load of a release."""
