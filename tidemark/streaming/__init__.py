"""Running the operators as Structured Streaming queries."""
