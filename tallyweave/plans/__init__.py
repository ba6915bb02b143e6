"""Plans of tallyweave."""
