"""End-to-end flows composed from sources, operators and sinks."""
