"""DataFrame building blocks."""
