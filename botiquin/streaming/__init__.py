"""Continuous forms of the batch copies."""
