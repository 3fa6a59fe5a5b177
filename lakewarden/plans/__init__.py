"""User-facing jobs composed of sources, operators and sinks."""
