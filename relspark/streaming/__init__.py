"""Streaming of the release-analytics engine."""
