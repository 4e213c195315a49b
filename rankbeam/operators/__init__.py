"""rankbeam.operators."""
