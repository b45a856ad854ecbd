"""Readers for landed data and the driver's test tables."""
