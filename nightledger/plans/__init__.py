"""Compositions of operators: the daily run, versioned publishing and the
registered query catalog."""
