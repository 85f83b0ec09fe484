"""Landed payloads, windowed scans and the stored tables."""
