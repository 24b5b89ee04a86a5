"""Sources and sinks: declared schemas, test-table adapters, CSV and table I/O."""
