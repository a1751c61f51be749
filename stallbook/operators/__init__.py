"""DataFrame-to-DataFrame steps of the ledger."""
