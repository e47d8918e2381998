"""Readers for landed payloads, series rows, config text and layer tables."""
