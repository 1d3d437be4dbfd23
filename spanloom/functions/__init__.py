"""Column functions. Each is stateless and row-local, so it runs on batch and streaming frames alike."""
