"""Table-to-table operators, one module per stage of the ledger."""
