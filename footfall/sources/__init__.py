"""Scans, sinks and staged intermediate tables."""
