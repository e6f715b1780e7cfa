"""Sources and sinks: driver tables, stand-in inputs, layer I/O."""
