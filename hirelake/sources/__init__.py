"""Scans, saved pages, versioned tables and table profiles."""
