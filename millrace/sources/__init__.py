"""Table and file sources and sinks."""
