"""Sources: bronze readers, layer routing, seeds, test-data adapter."""
