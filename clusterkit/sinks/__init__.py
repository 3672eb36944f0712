"""Text sinks."""
