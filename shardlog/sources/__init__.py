"""Reads and writes of record logs."""
