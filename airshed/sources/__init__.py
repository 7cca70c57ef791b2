"""Sources and sinks: driver tables, fixture adapters, CSV ingest, layer I/O."""
