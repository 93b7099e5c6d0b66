"""Relational and ML operators, each a DataFrame -> DataFrame function."""
