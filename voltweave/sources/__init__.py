"""Readers and writers: delimited layers, GeoJSON, checkpoints, listings."""
