"""The queries that check every operator against the test tables, with their SQL."""
