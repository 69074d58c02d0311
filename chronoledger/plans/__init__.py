"""Compositions: served datasets, run-level steps and the query registry."""
