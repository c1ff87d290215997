"""Scans, sinks and the bronze, silver and gold layers."""
