"""What to read next: decisions over stream, metadata and state tables, and the state table itself."""
