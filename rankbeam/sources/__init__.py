"""rankbeam.sources."""
