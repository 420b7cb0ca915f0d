"""DataFrame-to-DataFrame operators; each works for all symbols and all dates at once."""
