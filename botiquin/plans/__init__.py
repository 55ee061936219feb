"""Whole jobs: extract loads, the board, its reports, edits and synchronisation."""
