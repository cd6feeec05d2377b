"""Plans of the catalogue engine."""
