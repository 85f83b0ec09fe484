"""The operators bound to the benchmark tables, with their SQL oracles."""
