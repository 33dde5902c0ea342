"""Readers that turn nested or raw inputs into tables, and the sinks besides those of ``materialize``."""
