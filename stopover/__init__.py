"""Spark jobs for dated snapshots of nested search results."""
