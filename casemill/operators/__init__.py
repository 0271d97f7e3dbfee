"""DataFrame operators: pure, lazy, usable in batch and in micro-batches."""
