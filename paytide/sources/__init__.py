"""Table readers, incremental scans, change-event parsing and sinks."""
