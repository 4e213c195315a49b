"""rankbeam.plans."""
