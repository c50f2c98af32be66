"""Column expressions; row-local, so they work on batch and streaming frames alike."""
