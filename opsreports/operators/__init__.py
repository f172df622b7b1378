"""DataFrame operators: filters, joins, aggregates, sequences and the credit ledger."""
