"""Streaming of tallyweave."""
