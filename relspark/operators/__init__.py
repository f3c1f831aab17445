"""Operators of the release-analytics engine."""
