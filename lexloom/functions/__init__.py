"""Column -> Column building blocks; they work on batch and streaming frames alike."""
