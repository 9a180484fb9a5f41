"""Column functions on URLs, headers, timestamps and digests."""
