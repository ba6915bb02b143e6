"""tallyweave: a PySpark-native engine for published-ledger analytics."""
