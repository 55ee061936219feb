"""Relational building blocks shared by the plans."""
