"""DataFrame operators: discovery, snapshots, increments, documents, change events and merges."""
