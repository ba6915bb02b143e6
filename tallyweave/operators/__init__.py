"""Operators of tallyweave."""
