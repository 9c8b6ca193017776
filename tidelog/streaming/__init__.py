"""Streaming forms: bounded batches, deferral, ordered lanes, exactly-once file output, rebuilds."""
