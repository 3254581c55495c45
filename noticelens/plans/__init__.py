"""Catalogue queries on the given tables and their reference SQL."""
