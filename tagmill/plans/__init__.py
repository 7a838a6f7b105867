"""Jobs: whole runs put together from operators, sources and sinks."""
