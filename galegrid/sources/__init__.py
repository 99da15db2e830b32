"""Readers, fetch plans, loaders and the table catalogue."""
