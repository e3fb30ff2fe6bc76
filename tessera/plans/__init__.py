"""Queries and whole runs."""
