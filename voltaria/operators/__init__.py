"""Relational operators that Spark has no single call for, as compositions of DataFrame operations."""
