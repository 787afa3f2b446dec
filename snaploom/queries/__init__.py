"""Registry of queries and their SQL."""
