"""Sources and sinks: driver tables, fixture projections, files, manifests."""
