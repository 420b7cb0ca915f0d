"""Whole jobs composed of the operators; every job handles all symbols and all dates at once."""
