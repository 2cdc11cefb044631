"""Operators over whole record logs."""
