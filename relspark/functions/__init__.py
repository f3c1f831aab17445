"""Functions of the release-analytics engine."""
