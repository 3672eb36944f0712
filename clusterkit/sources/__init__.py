"""Text sources and record parsing."""
