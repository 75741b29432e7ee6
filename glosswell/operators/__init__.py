"""Building blocks the query plans share."""
