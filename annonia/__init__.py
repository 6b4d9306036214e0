"""Spark jobs for classified-ad and shop listing data."""
