"""Scans and sinks: JSON lines, CSV, the fixed-width report."""
