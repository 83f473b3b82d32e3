"""DataFrame -> DataFrame transforms: parsing, aggregation, windows, joins, state."""
