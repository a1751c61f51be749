"""Invoice-line analytics on Spark: clean, audit and summarise a merchandise ledger."""
