"""Plan checks and the batch job runner."""
