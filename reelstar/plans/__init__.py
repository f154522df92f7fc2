"""Reports over the star and the daily run."""
