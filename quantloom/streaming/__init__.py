"""Continuous loading."""
