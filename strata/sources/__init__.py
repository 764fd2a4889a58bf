"""Scans: landed files, seeds, registry datasets, partition listings, month ranges."""
