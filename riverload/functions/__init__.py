"""Column, join and aggregation helpers with the missing-value rules of the domain."""
