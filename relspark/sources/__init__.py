"""Sources of the release-analytics engine."""
