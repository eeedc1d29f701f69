"""kiln.streaming."""
