"""The stateful operators as Structured Streaming queries."""
