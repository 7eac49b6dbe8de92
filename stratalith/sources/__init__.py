"""Readers for byte and text formats that Spark has no built-in source for."""
