"""Sources and sinks: CSV, bullet lists, page snapshots, a search DataSource, progress tables."""
