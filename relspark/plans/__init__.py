"""Plans of the release-analytics engine."""
