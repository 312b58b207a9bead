"""Readers: landing folders, layer tables, the trip-shaped view, SQL texts."""
