"""CSV exports and the star warehouse."""
