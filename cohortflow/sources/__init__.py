"""Native schemas, readers, sinks, and the adapters from the driver tables."""
