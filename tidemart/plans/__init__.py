"""Compositions: the daily run, inputs derived from the raw tables, and the query registry."""
