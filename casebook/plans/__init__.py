"""Query catalogue: Spark queries and their SQL oracles."""
