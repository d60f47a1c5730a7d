"""DataFrame operators: parsing, quality, joins, merges and history."""
