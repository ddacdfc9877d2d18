"""Sources and sinks: page files, the raw table, catalog, export."""
