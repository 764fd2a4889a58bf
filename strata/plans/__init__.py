"""Composite jobs: the trip star schema wired from the generic operators."""
