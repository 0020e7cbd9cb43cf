"""Writers for chunked dumps, reports and stored tables."""
