"""Relational and clustering operators, each a DataFrame -> DataFrame function."""
