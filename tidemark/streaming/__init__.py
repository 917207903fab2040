"""Structured Streaming: change rows kept as batches, read as current state, folded into a new base."""
