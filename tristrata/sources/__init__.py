"""Scans, sinks and the shared working folder."""
