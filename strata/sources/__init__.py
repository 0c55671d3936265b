"""Sources and sinks: driver tables, CSV landing files, layer tables."""
