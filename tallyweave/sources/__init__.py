"""Sources of tallyweave."""
