"""Cross-chain transfer and settlement analytics as PySpark DataFrame functions."""
