"""DataFrame building blocks and domain operators."""
