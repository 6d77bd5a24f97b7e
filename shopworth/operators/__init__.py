"""DataFrame-to-DataFrame steps of the three analyses."""
