"""Column expressions: amounts, buckets, labels, addresses and JSON text."""
