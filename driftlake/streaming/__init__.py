"""The layers as Structured Streaming queries."""
