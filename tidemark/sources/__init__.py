"""Scans of the input tables and the sinks the jobs write."""
