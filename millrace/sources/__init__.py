"""Log sources and sinks."""
