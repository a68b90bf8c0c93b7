"""Sources and sinks: CSV bars, literal rows, date spine, catalog tables,
and the bar fixtures derived from the driver tables."""
