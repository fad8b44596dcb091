"""The live feed as Structured Streaming queries."""
