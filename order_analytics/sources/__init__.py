"""Sources and sinks: relational scans, versioned snapshots, mart tables, test fixtures."""
