"""Document scans, raw loads and table sinks."""
