"""The record jobs on Structured Streaming."""
