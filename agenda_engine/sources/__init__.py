"""Sources of the catalogue engine."""
