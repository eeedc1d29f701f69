"""kiln.sources."""
