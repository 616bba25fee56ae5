"""Sources and sinks: declared schemas, readers, writers, the table catalogue."""
