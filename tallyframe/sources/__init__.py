"""Landing, zones and sinks."""
