"""Functions of tallyweave."""
