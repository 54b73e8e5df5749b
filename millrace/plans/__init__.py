"""Driver queries and their SQL oracles."""
