"""Sinks: tables of a release dump, staged rewrites and driver-side results."""
