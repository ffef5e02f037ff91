"""Operators for preparing text and linked records: optional, used by nothing in the core."""
